"""Substring dedup over words by level-wise doubling.

A window of ``size`` words is removed where its word sequence also starts in a document with
a smaller doc_id.  The work goes by levels; only what repeats at one length is looked at again
at twice that length:

1. Half length.  Of the half-length grams in a window the one with the least hash stands for
   it (leftmost on ties), so equal windows choose equal grams, and neighbouring windows mostly
   share theirs.  The starts that share a chosen gram form a block.  A gram found in one
   document only has no repeated window: its block is done.
2. Blocks of repeated grams.  Blocks are compared whole (all words from the first window's
   start to the last one's end).  A block that a smaller doc_id has too is removed whole.
3. Full length.  Where one gram has several different blocks, the windows of the first
   document of each block are compared one by one, under their gram.

``repeat_levels`` goes on with this doubling (2, 4, 8 ... times ``size``) until no candidate
survives, and tells how long the repeats are.

A key is always two 64-bit hashes, of the gram and of the block or window around it.  Copies
are combined before each shuffle (a block counts once, whatever the number of its copies).
Per document no more than its own words are held in memory.

Defined results: a null text has no words; rows that repeat a doc_id are rows of their own
and none of them is smaller than the other; rows with a null doc_id have no order, so they
neither lose words nor make others lose any.  Extra columns are ignored.  An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import stage

SIZE = 50
SLICE_BYTES = 1 << 20

_U = np.uint64
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x + _U(salt & (2**64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    kept = _POWERS.get(base)
    if kept is None or len(kept[0]) <= n:
        count = max(n + 1, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        kept = tuple(np.cumprod(np.concatenate((np.ones(1, _U), np.full(count - 1, b, _U))), dtype=_U) for b in (base, inverse))
        _POWERS[base] = kept
    return kept


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of ``text``; long texts go in slices cut at white space."""
    parts, at = [], 0
    while at < len(text):
        end = min(len(text), at + SLICE_BYTES)
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        parts.append(_slice_hashes(np.frombuffer(text, np.uint8, end - at, at)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, _U)


def _slice_hashes(octets: np.ndarray) -> np.ndarray:
    inside = np.concatenate(([False], ~_SPACE[octets], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    up, down = _powers(_BYTE_BASE, len(octets))
    sums = np.concatenate(([_U(0)], np.cumsum((octets.astype(_U) + _U(1)) * up[: len(octets)], dtype=_U)))
    return _mix((sums[end] - sums[start]) * down[start], 1)


class Windows:
    """Hashes of any run of words of one or more documents laid end to end."""

    def __init__(self, words: np.ndarray):
        up, self.down = _powers(_WORD_BASE, len(words))
        self.sums = np.concatenate(([_U(0)], np.cumsum(words * up[: len(words)], dtype=_U)))

    def at(self, start: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start], salt)


def blocks(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """(document number, gram hash, block hash, first start, last start) of documents laid end
    to end; ``counts`` are their words, starts count from the document's first word."""
    half = size // 2
    n = len(words)
    if n < size:
        return (np.empty(0, np.int64), *[np.empty(0, _U)] * 2, *[np.empty(0, np.int64)] * 2)
    hashed = Windows(words)
    first = np.arange(n - half + 1)
    gram = hashed.at(first, first + half, 2)
    span = size - half + 1
    view = np.lib.stride_tricks.sliding_window_view(gram, span)
    chosen = np.concatenate([np.argmin(view[i:i + 65536], axis=1) for i in range(0, len(view), 65536)])
    chosen = chosen + np.arange(len(chosen))
    begin = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), np.maximum(counts - size + 1, 0))
    ahead = np.cumsum(np.maximum(counts - size + 1, 0)) - np.maximum(counts - size + 1, 0)
    start = np.arange(len(doc)) - ahead[doc] + begin[doc]
    own = chosen[start]
    new = np.concatenate(([True], (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])))[: len(own)]
    at = np.flatnonzero(new)
    lo, hi = start[at], start[np.concatenate((at[1:], [len(own)])) - 1] if len(at) else start[at]
    gram_at = own[at]
    whole = hashed.at(lo, hi + size, 3)
    whole = _mix(whole ^ ((gram_at - lo).astype(_U) << _U(32)) ^ (hi - lo).astype(_U), 4)
    return doc[at], gram[gram_at], whole, lo - begin[doc[at]], hi - begin[doc[at]]


_KEY = "doc_id long, text_key long"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of a batch, about SLICE_BYTES of text at once."""
    held, begin, n = [], 0, 0
    for i, t in enumerate(batch.column(text)):
        held.append((t.as_py() or "").encode())
        n += len(held[-1])
        if n >= SLICE_BYTES or i + 1 == batch.num_rows:
            yield batch.slice(begin, len(held)), held
            held, begin, n = [], i + 1, 0


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")


def all_blocks(docs: DataFrame, size: int) -> DataFrame:
    """Blocks of every document with a doc_id: doc_id, text_key, gram, block, lo, hi."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some, texts in _slices(b, 2):
                words = [word_hashes(t) for t in texts]
                doc, gram, block, lo, hi = blocks(np.concatenate(words), np.array([len(w) for w in words]), size)
                at = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(at), some.column(1).take(at), _signed(gram), _signed(block),
                     pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
                    ["doc_id", "text_key", "gram", "block", "lo", "hi"])

    return _keyed(docs.where("doc_id IS NOT NULL")).mapInArrow(run, f"{_KEY}, gram long, block long, lo int, hi int")


def windows_of(docs: DataFrame, ranges: DataFrame, size: int, length: int | None = None) -> DataFrame:
    """A row (doc_id, text_key, gram, hash, start) for each start in ``ranges`` (doc_id,
    text_key, gram, lo, hi), hashed over ``length`` words (default ``size``)."""
    length = length or size
    per_doc = ranges.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("gram", "lo", "hi")).alias("r"))
    per_doc = per_doc.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), F.col("r.gram").alias("gram"),
                             F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi"))
    joined = _keyed(docs).join(per_doc, (F.col("doc_id") == F.col("d")) & (F.col("text_key") == F.col("k"))).drop("d", "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                hashed = Windows(words := word_hashes(b.column(2)[i].as_py().encode()))
                gram, lo, hi = (b.column(c)[i].values.to_numpy() for c in (3, 4, 5))
                hi = np.minimum(hi, len(words) - length)
                count = np.maximum(hi - lo + 1, 0)
                of = np.repeat(np.arange(len(lo)), count)
                start = np.arange(len(of)) - (np.cumsum(count) - count)[of] + lo[of]
                if len(of):
                    own = [pa.array([b.column(c)[i].as_py()] * len(of), pa.int64()) for c in (0, 1)]
                    yield pa.RecordBatch.from_arrays(
                        [*own, pa.array(gram[of]), _signed(hashed.at(start, start + length, 5)),
                         pa.array(start.astype(np.int32))], ["doc_id", "text_key", "gram", "hash", "start"])

    return joined.mapInArrow(run, f"{_KEY}, gram long, hash long, start int")


def _repeated(found: DataFrame, *key: str) -> DataFrame:
    """Keys that more than one document has, with the first of these."""
    return (found.groupBy(*key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
            .where("first < last").drop("last"))


def repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, text_key, lo, hi): ranges of starts whose windows a smaller doc_id has too."""
    found = stage(all_blocks(docs, size), "blocks")
    # aggregates are staged before they are joined back: then both sides of a join are plain
    # exchanges, and a gram or block that many documents share is split among tasks (skew join)
    grams = stage(_repeated(found.select("gram", "doc_id"), "gram").select("gram"), "grams")
    again = stage(found.join(grams, "gram", "left_semi"), "again")
    by_block = stage(again.groupBy("gram", "block").agg(F.min("doc_id").alias("first")), "firsts")
    several = stage(by_block.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "several")
    placed = again.join(by_block, ["gram", "block"])
    whole = placed.where("doc_id > first").select("doc_id", "text_key", "lo", "hi")
    firsts = (placed.where("doc_id = first").select("doc_id", "text_key", "gram", "lo", "hi")
              .join(several, "gram", "left_semi").select("doc_id", "text_key", "gram", "lo", "hi"))
    windows = stage(windows_of(docs, firsts, size), "windows")
    single = (windows.join(stage(_repeated(windows, "gram", "hash"), "doubled"), ["gram", "hash"]).where("doc_id > first")
              .select("doc_id", "text_key", F.col("start").alias("lo"), F.col("start").alias("hi")))
    return whole.unionByName(single)


def cover(n: int, lo: np.ndarray, hi: np.ndarray, size: int) -> np.ndarray:
    """Which of n words the windows starting in the ranges cover."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, lo, 1)
    np.add.at(steps, hi + size, -1)
    return np.cumsum(steps[:-1]) > 0


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept (the kept
    words joined by one space) and kept_sha256."""
    found = repeats(docs, size).groupBy("doc_id", "text_key").agg(
        F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))
    found = found.withColumnsRenamed({"doc_id": "d", "text_key": "k"})
    joined = _keyed(docs).join(found, (F.col("doc_id") == F.col("d")) & (F.col("text_key") == F.col("k")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                out = []
                for i in range(some.num_rows):
                    words = (some.column(1)[i].as_py() or "").encode().split()
                    n = len(words)
                    if some.column(2)[i].is_valid:
                        lo, hi = (some.column(c)[i].values.to_numpy().astype(np.int64) for c in (2, 3))
                        words = [w for w, gone in zip(words, cover(n, lo, hi, size).tolist(), strict=True) if not gone]
                    kept = b" ".join(words)
                    out.append((n, n - len(words), kept.decode(), hashlib.sha256(kept).hexdigest()))
                cells = [pa.array(c, kind) for c, kind in
                         zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([some.column(0), *cells],
                                                 ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return joined.select("doc_id", "text", "lo", "hi").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")


def repeat_levels(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(length, documents, windows): what repeats at ``size``, twice that, and so on until no
    candidate survives.  A window is a candidate at twice a length where it and the window
    after it repeat at that length."""
    spark = docs.sparkSession
    found = stage(all_blocks(docs, size), "blocks")
    grams = _repeated(found.select("gram", "doc_id"), "gram").select("gram")
    ranges = found.join(grams, "gram", "left_semi").select("doc_id", "text_key", F.lit(0).cast("long").alias("gram"), "lo", "hi")
    out, length = [], size
    while True:
        windows = stage(windows_of(docs, ranges, size, length), "level")
        alive = stage(windows.join(_repeated(windows, "hash"), "hash", "left_semi")
                      .select("doc_id", "text_key", "start").distinct(), "alive")
        row = alive.agg(F.countDistinct("doc_id").alias("documents"), F.count("*").alias("windows")).first()
        if not row.windows:
            break
        out.append((length, row.documents, row.windows))
        after = alive.select("doc_id", "text_key", (F.col("start") - length).alias("start"))
        ranges = alive.join(after, ["doc_id", "text_key", "start"], "left_semi").select(
            "doc_id", "text_key", F.lit(0).cast("long").alias("gram"), F.col("start").alias("lo"), F.col("start").alias("hi"))
        length *= 2
    return spark.createDataFrame(out, "length long, documents long, windows long")
