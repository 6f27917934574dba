"""Canonical exact digests: Unicode normalisation, case and white space folding, wide xxhash.

Only built-in functions run on the rows. Text of code points that normalisation leaves alone passes
straight; words with others are decomposed (compatibility), their marks put in canonical order, and
composed again by lookups in maps drawn from the Unicode database, Hangul by arithmetic.

Rows of equal digests make a bucket, and texts are compared byte by byte inside buckets of several rows.
``group`` is the least doc_id of a row's text, null if none of its rows has one.

Edge cases: a null text is empty; texts under three code points are their own edited text; among
repeated doc_ids the lesser text comes first; a null doc_id comes after all others; a table of one row
is its own next document; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import functools
import math
import sys
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import sized, stage, table

LEAST = -(1 << 63)
#: Bytes of text of one key range, and ranges at most.
RANGE_BYTES, RANGES = 16 << 20, 1 << 16
#: Cuts of ranges that one look goes through, of which two find a range.
LOOK = 256
_PAIR, _NEXT = "\x01", "\x02"


@functools.cache
def _unicode() -> tuple[str, str, str, str]:
    """A class of inert code points for regular expressions, and the maps of decompositions, of
    combining classes and of compositions as strings."""
    inert, parts, classes, pairs = [], {}, {}, {}
    seconds = set()
    for c in map(chr, range(sys.maxunicode + 1)):
        canonical = unicodedata.decomposition(c)
        if canonical and canonical[0] != "<" and " " in canonical and unicodedata.normalize("NFC", c) == c:
            a, b = (chr(int(x, 16)) for x in canonical.split())
            pairs[a + b] = c
            seconds.add(b)
    start = None
    for n in range(sys.maxunicode + 2):
        c = chr(n) if n <= sys.maxunicode else ""
        alone = bool(c) and not 0xD800 <= n < 0xE000 and unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c) and c not in seconds and not 0x1100 <= n < 0x1200
        if alone and start is None:
            start = n
        elif not alone and start is not None:
            if n - start >= 16:
                inert.append((start, n - 1))
            start = None
        if not c or 0xAC00 <= n < 0xD7A4 or 0xD800 <= n < 0xE000:
            continue
        if (k := unicodedata.normalize("NFKD", c)) != c:
            parts[c] = k
        if v := unicodedata.combining(c):
            classes[c] = str(v)
    ranges = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in inert)
    return ranges, *(_NEXT.join(f"{k}{_PAIR}{v}" for k, v in m.items()) for m in (parts, classes, pairs))


def _odd(text) -> F.Column:
    """Whether normalisation may change a text. Java reads a class of up to two ranges some twenty times
    faster than a longer one, so the first two decide about most texts."""
    inert = _unicode()[0]
    few = "".join(inert.split("\\x")[:5]).replace("{", "\\x{")
    return text.rlike(f"[^{few}]") & text.rlike(f"[^{inert}]")


def _syllable(a, b) -> F.Column:
    """The Hangul syllable that two characters make, or null."""
    x, y = F.ascii(a), F.ascii(b)
    two = F.when(x.between(0x1100, 0x1112) & y.between(0x1161, 0x1175), 0xAC00 + ((x - 0x1100) * 21 + y - 0x1161) * 28)
    code = two.when(x.between(0xAC00, 0xD7A3) & (F.pmod(x - 0xAC00, F.lit(28)) == 0) & y.between(0x11A8, 0x11C2), x + y - 0x11A7)
    # three bytes of UTF-8
    raw = F.lit(0xE08080) + F.floor(code / 4096) * 65536 + F.pmod(F.floor(code / 64), F.lit(64)) * 256 + F.pmod(code, F.lit(64))
    return F.decode(F.unhex(F.hex(raw.cast("long"))), "UTF-8")


def _lookup(text: str) -> F.Column:
    return F.str_to_map(F.lit(text), F.lit(_NEXT), F.lit(_PAIR))


def _normal_word(word) -> F.Column:
    _, parts, classes, pairs = _unicode()
    each = lambda s: F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0))
    part, kind, pair = _lookup(parts), _lookup(classes), _lookup(pairs)
    chars = each(F.array_join(F.transform(each(word), lambda c: F.coalesce(F.try_element_at(part, c), c)), ""))
    rank = lambda c: F.coalesce(F.try_element_at(kind, c).cast("int"), F.lit(0))
    marked = F.transform(chars, lambda c: F.struct(rank(c).alias("k"), c.alias("c")))
    # each starter begins a run; its marks follow in the order of their classes
    runs = F.aggregate(
        marked,
        F.expr("struct(0 AS r, cast(array() AS array<struct<r:int,k:int,i:int,c:string>>) AS out)"),
        lambda s, x: F.struct((s.r + (x.k == 0).cast("int")).alias("r"), F.concat(s.out, F.array(F.struct((s.r + (x.k == 0).cast("int")).alias("r"), x.k.alias("k"), F.size(s.out).alias("i"), x.c.alias("c")))).alias("out")),
    )

    def step(s, x):
        made = F.coalesce(F.try_element_at(pair, F.concat(s.starter, x.c)), _syllable(s.starter, x.c))
        joins = made.isNotNull() & F.when(x.k > 0, s.last < x.k).otherwise((s.rest == "") & (s.starter != ""))
        state = lambda done, starter, rest, last: F.struct(done.alias("done"), starter.alias("starter"), rest.alias("rest"), last.alias("last"))
        kept = F.when(x.k > 0, state(s.done, s.starter, F.concat(s.rest, x.c), x.k)).otherwise(state(F.concat(s.done, s.starter, s.rest), x.c, F.lit(""), F.lit(0)))
        return F.when(joins, state(s.done, made, s.rest, s.last)).otherwise(kept)

    return F.aggregate(F.array_sort(runs.out), F.expr("struct('' AS done, '' AS starter, '' AS rest, 0 AS last)"), step, lambda s: F.concat(s.done, s.starter, s.rest))


def canonical(text) -> F.Column:
    """A text normalised (NFKC), case folded, with white space as single spaces and none at the ends."""
    text = F.coalesce(text, F.lit(""))
    normal = F.when(~_odd(text), text).otherwise(F.array_join(F.transform(F.split(text, " "), lambda w: F.when(_odd(w), _normal_word(w)).otherwise(w)), " "))
    folded = F.replace(F.lower(F.upper(normal)), F.lit("ς"), F.lit("σ"))
    return F.trim(F.regexp_replace(folded, r"[\s\p{Z}\x{85}]+", " "))


def digest(canon) -> F.Column:
    """128 bits: two xxhash64 of a canonical text, the second behind a fixed word."""
    half = lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")
    return F.concat(half(F.xxhash64(canon)), half(F.xxhash64(F.lit("wide"), canon)))


def _identified(docs: DataFrame) -> DataFrame:
    """(doc_id, canon, fp) of the rows of ``docs``."""
    return docs.select("doc_id", canonical(F.col("text")).alias("canon")).withColumn("fp", digest(F.col("canon")))


def classes(docs: DataFrame, fps: DataFrame) -> DataFrame:
    """(fp, variant, group) of the buckets of several rows: a row for each text of the bucket.

    ``fps`` are the staged digests of ``docs``, one a row. Texts are grouped by their bytes, with partial
    aggregation, so of a hot bucket each task sends a text once; texts of single rows aren't sent if the
    buckets' table is small enough for a broadcast. ``variant`` is the text's SHA-256.
    """
    several = stage(fps.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp"), "buckets")
    d = _identified(docs)
    if (small := sized(several, "fp")) is not None:
        d = d.join(small, "fp", "left_semi")
    found = d.groupBy("fp", "canon").agg(F.min("doc_id").alias("group"))
    return stage(found.select("fp", F.sha2("canon", 256).alias("variant"), "group"), "classes")


def with_group(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (doc_id, fp, variant, ...) with ``group``; a hot text's rows are dealt to many tasks."""
    if (small := sized(found, "fp", "variant")) is not None:
        out = rows.join(small, ["fp", "variant"], "left")
    else:
        salts = 64
        out = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
        out = out.join(found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["fp", "variant", "salt"], "left").drop("salt")
    return out.withColumn("group", F.coalesce("group", "doc_id"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, group): equal canonical texts share the least doc_id of theirs."""
    rows = stage(_identified(docs).select("doc_id", "fp", F.sha2("canon", 256).alias("variant")), "digests")
    return with_group(rows, classes(docs, rows.select("fp"))).select("doc_id", "group")


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Add ``_next``, a struct of ``carried`` of the next document by descending doc_id (last: the first).

    Keys are cut into ranges at keys that occur, so a range's first row is known: it also goes, as a
    guest, to the range above, whose last row needs it; and the very first to the lowest range.
    """
    spark = docs.sparkSession
    d = docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)))
    size, top = d.agg(F.sum(F.octet_length("text")), F.max("_key")).first()
    n = min(RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((size or 0) / RANGE_BYTES)))
    cuts = d.agg(F.percentile_approx("_key", [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0] if top is not None else None
    cuts = sorted({*(cuts or []), top} - {None}) or [0]
    ends = F.lit(cuts).cast("array<long>")
    # the look-up goes through every LOOK-th cut, then through the cuts after the last one below
    coarse = F.size(F.filter(F.lit(cuts[LOOK - 1 :: LOOK]).cast("array<long>"), lambda e: e < F.col("_key"))) * LOOK
    at = coarse + F.size(F.filter(F.slice(ends, coarse + 1, F.lit(LOOK)), lambda e: e < F.col("_key")))
    home = lambda r, g: F.struct(r.cast("int").alias("r"), F.lit(g).alias("g"))
    none = F.expr("cast(array() AS array<struct<r:int,g:int>>)")
    d = d.withColumn("_at", at)
    above = F.when((F.get(ends, F.col("_at")) == F.col("_key")) & (F.col("_at") < len(cuts) - 1), F.array(home(F.col("_at") + 1, 1))).otherwise(none)
    around = F.when(F.col("_key") == F.lit(cuts[-1]), F.array(home(F.lit(0), 2))).otherwise(none)
    d = d.withColumn("_home", F.explode(F.concat(F.array(home(F.col("_at"), 0)), above, around)))
    d = d.withColumns({"_range": F.col("_home.r"), "_guest": F.col("_home.g")})
    order = W.partitionBy("_range").orderBy((F.col("_guest") == 2).cast("int"), F.col("_key").desc(), "text")
    d = d.withColumn("_next", F.lead(F.struct(*carried)).over(order))
    return d.where("_guest = 0").drop("_key", "_at", "_home", "_range", "_guest")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    d = docs.withColumn("canon", canonical(F.col("text"))).withColumns({"fp": digest(F.col("canon")), "variant": F.sha2("canon", 256)}).drop("canon")
    d = with_next(d, ["text", "fp"]).withColumn("n_chars", F.length("text").cast("long"))
    tail = F.expr("cast(n_chars div 3 AS int)")
    d = d.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - tail).cast("int")), F.substring(F.col("_next.text"), F.lit(1), tail)))
    # in a lambda, the edited text is put together once, not once a use
    d = d.withColumn("edited_canon", F.get(F.transform(F.array("edited"), canonical), F.lit(0))).withColumn("edited_fingerprint", digest(F.col("edited_canon")))
    # equal digests are confirmed byte by byte; unequal ones need no second look
    same = lambda fp, canon: F.when(F.col("fp") == fp, (canonical(F.col("text")) == canon).cast("double")).otherwise(F.lit(0.0))
    narrow = stage(d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "variant", "edited_fingerprint", same(F.col("edited_fingerprint"), F.col("edited_canon")).alias("near_edited"), same(F.col("_next.fp"), canonical(F.col("_next.text"))).alias("near_next")), "fingerprints")
    out = with_group(narrow, classes(docs, narrow.select("fp")))
    return out.select("doc_id", "n_chars", "edited_sha256", F.col("fp").alias("fingerprint"), "edited_fingerprint", "near_edited", "near_next", F.col("group").alias("exact_group"))
