"""Best-fit packing of tokenised documents under several capacities.

A document is its token ids and id 2; one longer than a sequence is cut into whole sequences after a
first piece that may be shorter. Pieces are packed by vector best fit, largest first: of the kinds of
open bins in which a piece fits under every capacity (tokens, documents, attention cost = the sum of
squared lengths), the one with the best score takes it, a weighted dot product of demand and what is
left, or the least weighted norm of what would be left. As pieces of one length are alike, the choice
runs on the histogram of lengths (at most 1,024 numbers) and yields kinds of bins with multiplicities;
pieces then take their places by rank within their length.

Edge cases: a null text is empty, one token; a null doc_id is kept; repeated rows are packed each;
an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, arrow_limits, stage, table

END, LENGTH = 2, 1024
#: Fixed value: how byte-level pre-tokenizers cut texts.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Capacity:
    """Of one sequence. Documents and cost bind only when set below what the tokens allow."""

    tokens: int = LENGTH
    documents: int = LENGTH
    cost: int = LENGTH * LENGTH
    weights: tuple[float, float, float] = (1.0, 0.01, 0.1)
    score: str = "norm"  # or "dot"


def best_fit(histogram: dict[int, int], cap: Capacity = Capacity()) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Kinds of bins as ((length, how many), ...) with their multiplicities.

    Bins of one kind are alike, so a kind takes a piece in all its bins at once, as far as pieces go.
    """
    full = np.array([cap.tokens, cap.documents, cap.cost], float)
    weights = np.array(cap.weights)
    kinds: Counter[tuple[tuple[int, int], ...]] = Counter()
    left: dict[tuple[tuple[int, int], ...], tuple[int, int, int]] = {}

    def put(kind, length, n):
        rest = left.get(kind, (cap.tokens, cap.documents, cap.cost))
        new = (*kind[:-1], (length, kind[-1][1] + n)) if kind and kind[-1][0] == length else (*kind, (length, n))
        left[new] = (rest[0] - n * length, rest[1] - n, rest[2] - n * length * length)
        return new

    def room(rest, length):
        return min(rest[0] // length, rest[1], rest[2] // (length * length))

    for length in sorted(histogram, reverse=True):
        count = histogram[length]
        if length > cap.tokens or length * length > cap.cost or not cap.documents:
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        demand = np.array([length, 1, length * length]) / full
        while count:
            fits = [k for k in kinds if room(left[k], length)]
            if not fits:
                most = room((cap.tokens, cap.documents, cap.cost), length)
                if count >= most:
                    kinds[put((), length, most)] += count // most
                if count % most:
                    kinds[put((), length, count % most)] += 1
                break
            rests = np.array([left[k] for k in fits]) / full
            value = rests @ (weights * demand) if cap.score == "dot" else -(weights * (rests - demand) ** 2).sum(axis=1)
            kind = fits[int(np.argmax(value))]
            # the chosen bin stays the best fit for its own next pieces: it has less left than before
            n = room(left[kind], length) if cap.score == "norm" else 1
            bins = min(kinds[kind], count // n)
            if bins:
                kinds[put(kind, length, n)] += bins
                count -= bins * n
            else:
                kinds[put(kind, length, count)] += 1
                bins, count = 1, 0
            kinds[kind] -= bins
            if not kinds[kind]:
                del kinds[kind]
    return sorted(kinds.items(), reverse=True)


def intervals(kinds: list[tuple[tuple[tuple[int, int], ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, pieces of it a bin, first sequence, offset in the sequence)."""
    out, taken, sequence = [], Counter(), 0
    for kind, bins in kinds:
        offset = 0
        for length, n in kind:
            out.append((length, taken[length], taken[length] + n * bins, n, sequence, offset))
            taken[length] += n * bins
            offset += n * length
        sequence += bins
    return out


class Tokens:
    """Token ids of whole texts by a tokenizer file.

    The merges of a plain byte-level BPE file (ids in the order of its merges, no normaliser) run in
    tiktoken, on the file's own vocabulary and pattern: its ids are those of ``tokenizers`` in a sixth of
    the time. Texts with an added token, or with a run of white space so long that the other's expression
    would overflow its stack, and all texts under any other file, go to ``tokenizers``.
    """

    #: Aligned blocks in which a long run of white space shows: one of twice as many code points covers one.
    RUN = 16384

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        file = json.loads(self.tokenizer.to_str())
        self.added = [t["content"] for t in file["added_tokens"]]
        self.plain = _plain(file)

    def _slow(self, text: str) -> bool:
        return any(a in text for a in self.added) or any(text[k : k + self.RUN].isspace() for k in range(0, len(text) - self.RUN + 1, self.RUN))

    def ids(self, text: str) -> np.ndarray:
        if self.plain is None or self._slow(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.plain.encode_ordinary(text), np.uint32)


def _plain(file: dict):
    """The file's byte-level BPE as a tiktoken encoding, or None if it is more than that."""
    import tiktoken

    model, cut = file["model"], file["pre_tokenizer"] or {}
    if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    if file["normalizer"] or file["post_processor"] or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]:
        return None
    vocabulary, pairs = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if len(vocabulary) != 256 + len(pairs) or any(vocabulary.get(a + b) != 256 + k for k, (a, b) in enumerate(pairs)):
        return None
    # a byte-level vocabulary writes printable Latin-1 bytes as themselves, the others from U+0100 on
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*seen}))}
    ranks = {bytes(byte[c] for c in word): n for word, n in vocabulary.items()}
    return tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


_tokens: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    return _tokens[path]


def cuts(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n > 0 tokens."""
    first = n - (n - 1) // length * length
    return [(0, first), *((s, length) for s in range(first, n, length))]


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text is tokenised whole, once."""
    arrow_limits(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = memoryview(np.append(known.ids(text or ""), np.uint32(END)).astype("<u4"))
                rows += [(doc_id, k, s, n, zlib.crc32(ids[s : s + n])) for k, (s, n) in enumerate(cuts(len(ids), length))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_PIECES)], schema=_PIECES)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(cut: DataFrame, cap: Capacity = Capacity(), rows_a_group: int = 100_000) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ...).

    Ranks within a length are ranks within (length, group) plus the rows of the groups before, so a
    length that most pieces have is spread over as many tasks as it needs. Groups are dealt by a number
    of the row, written with it, so that equal rows spread as well.
    """
    spark = cut.sparkSession
    cut = stage(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(8, -(-cut.count() // rows_a_group))
    cut = cut.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)).cast("int"))
    counts = stage(cut.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("_n")), "pack-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    places = intervals(best_fit(histogram, cap))
    plan = spark.createDataFrame(places, "_length long, _from long, _to long, _each long, _first long, _offset long")
    if len(places) <= BROADCAST_ROWS:
        plan = F.broadcast(plan)
    before = W.partitionBy("length").orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    if len(histogram) * groups <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    ranked = cut.withColumn("_rank", F.row_number().over(W.partitionBy("length", "_group").orderBy("doc_id", "piece")) - 1)
    ranked = ranked.join(firsts, ["length", "_group"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    out = ranked.join(plan, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    at = F.col("_rank") - F.col("_from")
    out = out.withColumns({"sequence_id": F.col("_first") + F.floor(at / F.col("_each")), "offset": F.col("_offset") + F.pmod(at, F.col("_each")) * F.col("length")})
    return out.select(*(c for c in out.columns if not c.startswith("_")))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, cap: Capacity = Capacity()) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of ``docs`` (doc_id, text)."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pack(pieces(docs, tokenizer, cap.tokens), cap)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
