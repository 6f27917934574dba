"""Near duplicates by b-bit MinHash: banded candidates, packed low bits, exact confirmation.

1. Every text becomes its set of 5-word shingles (64-bit hashes), 160 minima, 40 bands of 4 minima and
   a packed signature of the low 4 bits of each minimum. Documents with equal sets are one class.
2. Classes that share a band bucket are candidates. Each is held against the bucket's hub by bit counts;
   an estimate of 0.57 (five standard errors under 0.75) or more joins them. Buckets that still hold
   members of several groups are compared in full, in blocks.
3. Each group of candidates is confirmed on the full shingle sets, in cells of bounded size, of which
   each gives a spanning forest of its links, never all pairs. Groups larger than a block are first held
   against a few hubs in one linear pass; rows that those link need no cells with each other.

A pair at 0.75 is in no common bucket with a chance under 3e-7. Edge cases: a null or wordless text has
an empty set and links with nothing; fewer than five words make one shingle; a null doc_id links with
nothing, has a null component and is kept; repeated rows are copies of each other; rows that repeat a
doc_id with another text link through that number; an empty table gives no rows. Other columns of the
input aren't touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_limits, stage, table
from .graph import components

SHINGLE, MINIMA, ROWS, LOW = 5, 160, 4, 4
BANDS, LANES = MINIMA // ROWS, 64 // LOW
LONGS = MINIMA // LANES
THRESHOLD, CANDIDATE = 75, 0.57
#: Equal low bits by chance, and the equal lanes that an estimate of CANDIDATE needs.
CHANCE = 2.0**-LOW
NEEDED = int(np.ceil(MINIMA * (CHANCE + CANDIDATE * (1 - CHANCE))))
#: Members and bytes of shingles of one block (a cell holds two blocks), and hubs of a larger group.
BLOCK_ROWS, BLOCK_BYTES, BUCKET_ROWS, HUBS = 1024, 4 << 20, 1024, 3

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RNG = np.random.default_rng(20240229)
_XOR = _RNG.integers(0, 1 << 32, MINIMA, dtype=np.uint32)[:, None]
_MUL = _RNG.integers(0, 1 << 31, MINIMA, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_SHIFTS = (np.arange(LANES, dtype=np.uint64) * np.uint64(LOW))[None, :]
_FOLD = np.uint64(0x1111111111111111)


class _Words(dict):
    """64-bit hashes of words; emptied between texts when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _C2
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_words) > 400_000:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(h))
    n = len(h) - width + 1
    acc = _mix(h[:n] + np.uint64(width))
    for k in range(1, width):
        acc = _mix(acc * _C1 + h[k : n + k])
    return np.unique(acc)


def minima(s: np.ndarray) -> np.ndarray:
    x = (s ^ (s >> np.uint64(32))).astype(np.uint32)
    out = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(out, ((x[None, at : at + 1024] ^ _XOR) * _MUL).min(axis=1), out=out)
    return out


def packed(m: np.ndarray) -> np.ndarray:
    """The low bits of the minima, mixed once more: unmixed ones depend on the low bits of the sets alone,
    so that a shingle would collide with another in all lanes or in none."""
    m = (m ^ (m >> np.uint32(16))) * np.uint32(0x7FEB352D)
    m = (m ^ (m >> np.uint32(15))) * np.uint32(0x846CA68B)
    m ^= m >> np.uint32(16)
    return np.bitwise_or.reduce((m & np.uint32(2**LOW - 1)).astype(np.uint64).reshape(LONGS, LANES) << _SHIFTS, axis=1)


def bands(m: np.ndarray) -> np.ndarray:
    acc = _mix(np.arange(1, BANDS + 1, dtype=np.uint64) * _C1)
    for row in m.reshape(BANDS, ROWS).T.astype(np.uint64):
        acc = _mix(acc * _C1 + row)
    return acc


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sig", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, digest, sig, band = [], [], [], []
        for text in batch.column("text"):
            s = shingles(text.as_py())
            n.append(len(s))
            if not len(s):
                digest.append(None), sig.append(None), band.append(None)
                continue
            m = minima(s)
            digest.append(xxhash.xxh3_128_digest(s.tobytes()))
            sig.append(packed(m).view(np.int64))
            band.append(bands(m).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.list_(pa.int64())), pa.array(band, pa.list_(pa.int64()))], schema=_SIGNED)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest, sig, bands) a row; the last three are null for empty sets."""
    arrow_limits(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_sign, "doc_id long, n_shingles long, digest binary, sig array<long>, bands array<long>")


def estimate(a, b) -> F.Column:
    """Collision-corrected similarity of two packed signatures, by bit counts."""
    differ = F.lit(0)
    for i in range(LONGS):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(int(_FOLD)))
        differ = differ + F.bit_count(x)
    return ((MINIMA - differ) / F.lit(float(MINIMA)) - CHANCE) / (1 - CHANCE)


def _equal_lanes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    return MINIMA - np.bitwise_count(x & _FOLD).sum(axis=-1, dtype=np.int64)


class _Sets:
    """Union-find over row numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j

    def all(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.up))])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys from batches sorted by them; a group may span batches."""
    held: list[pa.Table] = []
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if not t.num_rows:
            continue
        columns = [t.column(k).to_numpy() for k in keys]
        change = np.zeros(t.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        if held and all(held[-1].column(k)[-1].as_py() == c[0] for k, c in zip(keys, columns)):
            pass
        elif held:
            yield pa.concat_tables(held)
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), t.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            held.append(t.slice(a, b - a))
            if b < t.num_rows:
                yield pa.concat_tables(held)
                held = []
    if held:
        yield pa.concat_tables(held)


def _sig_of(t: pa.Table) -> np.ndarray:
    return t.column("sig").combine_chunks().flatten().to_numpy().reshape(-1, LONGS).view(np.uint64)


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edges_out(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], schema=_EDGES)


def _bucket_forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate links between members of different groups in each cell of a bucket, as forests."""
    out: list[tuple[int, int]] = []
    for t in _groups(batches, ["h", "i", "j"]):
        if t.num_rows < 2:
            continue
        ids, roots, block = (t.column(c).to_numpy() for c in ("node", "root", "block"))
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        sig, sets = _sig_of(t), _Sets(len(ids))
        first: dict[int, int] = {}
        for k, r in enumerate(roots.tolist()):
            sets.join(first.setdefault(r, k), k)
        for k in range(len(ids) - 1):
            wanted = roots[k + 1 :] != roots[k]
            if i != j:
                wanted &= block[k + 1 :] != block[k]
            other = np.flatnonzero(wanted) + k + 1
            if len(other):
                for o in other[_equal_lanes(sig[other], sig[k]) >= NEEDED].tolist():
                    if sets.join(k, o):
                        out.append((int(ids[k]), int(ids[o])))
        if len(out) > 5000:
            yield _edges_out(out)
            out = []
    yield _edges_out(out)


def _true_links(full: list[np.ndarray], sizes: np.ndarray, k: int, other: list[int]) -> list[int]:
    """Those of the rows ``other`` that the full sets link with row ``k``."""
    if not other:
        return []
    starts = np.cumsum([0, *sizes[other][:-1]])
    every = np.concatenate([full[o] for o in other])
    at = np.searchsorted(full[k], every)
    at[at == len(full[k])] = 0
    shared = np.add.reduceat((full[k][at] == every).astype(np.int64), starts)
    return [o for o, both in zip(other, shared.tolist()) if 100 * both >= THRESHOLD * (sizes[k] + sizes[o] - both)]


def _with_hubs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each block's rows with the hubs of its group by the full shingle sets, as forests."""
    out: list[tuple[int, int]] = []
    for t in _groups(batches, ["sc", "block"]):
        ids, hub, sig = t.column("node").to_numpy(), t.column("hub").to_numpy(), _sig_of(t)
        full = [shingles(x.as_py()) for x in t.column("text")]
        sizes, sets = np.array([len(s) for s in full]), _Sets(len(ids))
        for k in np.flatnonzero(hub).tolist():
            other = np.flatnonzero(_equal_lanes(sig, sig[k]) >= NEEDED).tolist()
            own = sets.find(k)
            for o in _true_links(full, sizes, k, [o for o in other if sets.find(o) != own]):
                if sets.join(k, o):
                    out.append((int(ids[k]), int(ids[o])))
        if len(out) > 5000:
            yield _edges_out(out)
            out = []
    yield _edges_out(out)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each cell by the full shingle sets, beside those known (equal roots), as spanning forests."""
    out: list[tuple[int, int]] = []
    for t in _groups(batches, ["sc", "i", "j"]):
        if t.num_rows < 2:
            continue
        ids, block = t.column("node").to_numpy(), t.column("block").to_numpy()
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        full = [shingles(x.as_py()) for x in t.column("text")]
        sizes = np.array([len(s) for s in full])
        sig, sets = _sig_of(t), _Sets(len(ids))
        first: dict[int, int] = {}
        for k, r in enumerate(t.column("root").to_pylist()):
            sets.join(first.setdefault(r, k), k)
        # near-certain links first, so that the rest has fewer pairs left to look at
        for needed in (int(0.9 * MINIMA), NEEDED) if len(ids) > 8 else (NEEDED,):
            for k in range(len(ids) - 1):
                wanted = _equal_lanes(sig[k + 1 :], sig[k]) >= needed
                if i != j:
                    wanted &= block[k + 1 :] != block[k]
                other = (np.flatnonzero(wanted) + k + 1).tolist()
                own = sets.find(k)
                for o in _true_links(full, sizes, k, [o for o in other if sets.find(o) != own]):
                    if sets.join(k, o):
                        out.append((int(ids[k]), int(ids[o])))
        if len(out) > 5000:
            yield _edges_out(out)
            out = []
    yield _edges_out(out)


def _parted(rows: DataFrame, key: str, unit: int) -> DataFrame:
    """Deal the rows (key, node, root, w, all: the key's sum of w) of each key with several roots to blocks.

    Rows of one root are linked already. So a key of over ``unit`` has the rows of its largest root in blocks
    of their own, which meet the blocks of the others and not one another: ``others`` are a block's partners.
    """
    roots = rows.groupBy(key, "root").agg(F.sum("w").alias("w"))
    plan = roots.groupBy(key).agg(F.sum("w").alias("all"), F.max("w").alias("most"), F.max_by("root", F.struct("w", "root")).alias("main")).where("all > most")
    blocks, small = F.ceil(F.col("all") / unit).cast("int"), F.col("all") <= unit
    # a key that much of the corpus shares must not meet its plan in one task
    plan = plan.select(
        key,
        F.when(~small, F.col("main")).alias("main"),
        F.when(small, 1).otherwise(F.ceil((F.col("all") - F.col("most")) / unit)).cast("int").alias("rest"),
        F.when(small, 0).otherwise(F.ceil(F.col("most") / unit)).cast("int").alias("most"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("salt"),
    )
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("node", F.lit("salt")), blocks).cast("int")).join(plan, [key, "salt"])
    linked, at = F.col("root").eqNullSafe(F.col("main")), F.xxhash64("node")
    block = F.when(linked, F.col("rest") + F.pmod(at, F.greatest("most", F.lit(1)))).otherwise(F.pmod(at, F.col("rest"))).cast("int")
    last = F.col("rest") + F.when(linked, 0).otherwise(F.col("most")) - 1
    return rows.withColumns({"block": block, "others": F.sequence(F.lit(0), last)}).drop("salt", "main", "rest", "most", "w", "all")


def _cells(df: DataFrame) -> DataFrame:
    """Each block's rows in its cells with all its partners."""
    df = df.withColumn("other", F.explode("others"))
    return df.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("others", "other")


def _hub_links(large: DataFrame) -> DataFrame:
    """Links (a, b) of the rows (sc, node, sig, all, text) of groups larger than a block with up to HUBS rows of each."""
    hubs = large.groupBy("sc", F.pmod(F.xxhash64("node", F.lit("hub")), F.lit(HUBS))).agg(F.min_by("node", F.xxhash64("node")).alias("node"))
    blocks = F.ceil(F.col("all") / BLOCK_BYTES).cast("int")
    rows = large.join(hubs.select("node").distinct().withColumn("hub", F.lit(True)), "node", "left")
    rows = rows.withColumn("block", F.explode(F.when(F.col("hub"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), blocks).cast("int")))))
    rows = rows.select("sc", "block", "node", F.coalesce("hub", F.lit(False)).alias("hub"), "sig", "text")
    return rows.repartition("sc", "block").sortWithinPartitions("sc", "block", "node").mapInArrow(_with_hubs, "a long, b long")


def _grouped(df: DataFrame, key: str, function) -> DataFrame:
    """``function`` over partitions that hold whole (key, i, j) cells, sorted by them."""
    return df.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "node").mapInArrow(function, "a long, b long")


def link(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each of ``docs`` (doc_id, text)."""
    signed = stage(signatures(docs), "signed")
    named = signed.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = stage(named.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "classes")

    # candidates: buckets of two and more, each member against the hub
    rows = classes.select("node", F.explode("bands").alias("h"))
    hubs = rows.groupBy("h").agg(F.min_by("node", F.xxhash64("node", "h")).alias("hub"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo <> hi").select("h", "hub", "m")
    members = stage(rows.join(hubs, "h"), "members")
    sigs = classes.select("node", "sig")
    star = members.where("node <> hub").select("node", "hub").distinct().join(sigs, "node").join(sigs.select(F.col("node").alias("hub"), F.col("sig").alias("hub_sig")), "hub")
    star = stage(star.where(estimate(F.col("sig"), F.col("hub_sig")) >= CANDIDATE).select(F.col("hub").alias("a"), F.col("node").alias("b")), "star")
    groups = components(star)

    # buckets that still hold several groups; a bucket of two has been decided by its hub
    left = members.where("m > 2").join(groups, "node", "left").select("h", "node", F.coalesce("root", "node").alias("root"), F.lit(1).cast("long").alias("w"), F.col("m").alias("all"))
    left = _cells(_parted(left, "h", BUCKET_ROWS).join(sigs, "node"))
    more = stage(_grouped(left, "h", _bucket_forests), "more")
    if not more.isEmpty():
        groups = components(star.unionByName(more))

    # confirm each group on full sets
    inside = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("root", "sc")
    inside = inside.join(classes.select("node", "sig", F.greatest(F.col("n") * 8, F.lit(BLOCK_BYTES // BLOCK_ROWS)).alias("w")), "node")
    inside = inside.join(inside.groupBy("sc").agg(F.sum("w").alias("all")), "sc")
    # with their texts, so that the corpus is shuffled once and candidates alone go on; repeated rows count once
    inside = stage(inside.join(docs.select(F.col("doc_id").cast("long").alias("node"), "text"), "node").distinct(), "inside")
    links = stage(_hub_links(inside.where(F.col("all") > BLOCK_BYTES)), "hub-links")
    known = inside.withColumn("root", F.col("node"))
    if not links.isEmpty():
        known = inside.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    cells = _cells(_parted(known, "sc", BLOCK_BYTES)).select("sc", "i", "j", "block", "node", "root", "sig", "text")
    linked = components(links.unionByName(stage(_grouped(cells, "sc", _confirm), "links")))

    # rows without words, or without doc_id, aren't joined: as null keys they would meet in one task
    out = named.select("doc_id", "n_shingles", "digest").join(classes.select("digest", "node"), "digest").join(linked, "node", "left")
    alone = signed.where("doc_id IS NULL OR digest IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("node"), F.lit(None).cast("long").alias("root"))
    out = out.select("doc_id", "n_shingles", "node", "root").unionByName(alone)
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "node", "doc_id")).alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents").select("doc_id", "text"))


def near_sql(documents: str) -> str:
    """DuckDB SQL: (doc_id, n_shingles, component_id, kept) of ``documents`` by brute force."""
    return f"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM {documents}),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM w),
    x AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM s),
    links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id
      GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
    both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT doc_id, doc_id AS to_id FROM s UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.to_id = l.a),
    least AS (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY 1)
    SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN least USING (doc_id)"""


OP4_SQL = near_sql("documents")
