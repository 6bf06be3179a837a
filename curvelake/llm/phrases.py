"""Phrase collocations by a weighted de Bruijn graph.

Texts are lower-cased (A-Z), split at punctuation and line ends into pieces and those into words.
The graph of a language has the longest grams (``longest`` words) as edges, each between the two
grams of one word less that overlap in it.

1. Rare grams.  Grams of two and three words are counted by a hash of HASH_BITS.  A longer gram around
   one that occurs less than ``min_count`` times can't be a phrase, so texts are cut there as at a piece's
   end; this is told by a bitmap of FILTER_BITS, whose size does not grow: where it fills up fewer cuts
   are made, which costs work and changes no count.
2. Edges.  Every word position gives one row: the longest gram that starts there, shorter only
   before a cut.  Map tasks add up equal rows of SLICE_BYTES of text, then Spark does.
3. Node flow.  The count of a shorter gram is what flows out of it: the edges that begin with it
   plus the cuts right after it, which are the short rows.  So it is the sum over the distinct rows that
   it begins, again combined before the shuffle: a hot word or pair is a sum like any other.  The
   flow of single words, which most rows begin and end with, is added up in the map tasks.
4. Unary paths.  A node whose flow comes in by one edge and leaves by one edge, with no piece end
   on it, is inside a path.  Paths are compacted by pointer doubling on the frequent edges; such
   a node is always inside a longer phrase of the same count, so only the others are candidates.
5. Scores.  Every cut of a candidate is scored by ``SCALE * a / (l + r)`` in decimal arithmetic, the
   lowest one counts; candidates that a longer one explains are dropped.

Defined results: a null text counts as empty, a null language as ``und``; an empty or very short text
gives what words it has; texts of any length go in slices cut at piece ends (a piece is never cut);
repeated rows count each; ties go by score, count and phrase in UTF-8 byte order.  Extra columns
are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvelake.llm.common import stage
from curvelake.llm.substring import word_hashes

LONGEST = 4
MIN_COUNT = 30
TOP = 2000
SCALE = 2_000_000
COVERED = 80               # a longer candidate with this per cent of the count explains a phrase
SLICE_BYTES = 8 << 20      # text that a map task combines at once
ROWS_OUT = 50_000          # rows that a map task hands over at once
HASH_BITS = 40             # grams that share a hash are counted together: fewer cuts, same counts
FILTER_BITS = 1 << 26

_FILTER_LOG = FILTER_BITS.bit_length() - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_END = b"\xff"             # no byte of UTF-8: marks the end of a piece
_TABLE = bytes(ord(_END) if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b
               for b in range(256))


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def slices(texts: list[bytes]) -> Iterator[bytes]:
    """Texts with an end mark each, put together or cut (at end marks) to about SLICE_BYTES."""
    held, size = [], 0
    for t in texts:
        t = t.translate(_TABLE)
        at = 0
        while len(t) - at > SLICE_BYTES and (end := t.find(_END, at + SLICE_BYTES)) >= 0:
            yield t[at:end + 1]
            at = end + 1
        held.append(t[at:])
        size += len(held[-1])
        if size >= SLICE_BYTES:
            yield _END.join(held)
            held, size = [], 0
    if held:
        yield _END.join(held)


def numbered(text: bytes, room: int) -> tuple[list[bytes], np.ndarray]:
    """The distinct words and the number of the word at each place (0: a piece's end), ``room`` ends added."""
    numbers = _Numbers({_END: 0})
    at = [*map(numbers.__getitem__, text.replace(_END, b" \xff ").split()), *[0] * room]
    return list(numbers), np.array(at, np.int64)


def gram_hashes(lang: str, words: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of HASH_BITS of the two and of the three words from each place on, and of the language."""
    own = word_hashes(b" ".join([b"-", *words[1:]])) ^ np.uint64(zlib.crc32(lang.encode()))
    two = _mixed(own[at[:-2]], own[at[1:-1]])
    down = np.uint64(64 - HASH_BITS)
    return two >> down, _mixed(two, own[at[2:]]) >> down


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _ODD + b
    return (x ^ x >> np.uint64(29)) * _ODD


def rows_of(at: np.ndarray, two: np.ndarray, three: np.ndarray, longest: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows (word numbers at ``longest`` places, 0: none) and their counts; ``two`` and
    ``three`` say at which places grams of that length may be frequent."""
    n = len(at) - longest
    places = [at[:n]]
    for k in range(1, longest):
        goes_on = two[:n] if k == 1 else three[k - 2:n + k - 2]
        places.append(np.where(goes_on & (places[-1] > 0), at[k:n + k], 0))
    start = np.flatnonzero(at[:n])
    places = [p[start] for p in places]
    keys = [p << 32 | q for p, q in zip(places[::2], [*places[1::2], np.zeros_like(start)], strict=False)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    first = np.flatnonzero(new)
    return [p[order][first] for p in places], np.diff(np.append(first, len(order)))


def _by_slice(docs: DataFrame, make: Callable[[str, bytes], Iterator[pa.RecordBatch]], schema: str,
              text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows that ``make`` gives for the texts of one language, about SLICE_BYTES at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for b in batches:
            for key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(key, []).append(raw := t.encode())
                size += len(raw)
                if size >= SLICE_BYTES:
                    for each, texts in held.items():
                        for some in slices(texts):
                            yield from make(each, some)
                    held, size = {}, 0
        for each, texts in held.items():
            for some in slices(texts):
                yield from make(each, some)

    narrow = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                         F.coalesce(text, F.lit("")).alias("text"))
    return narrow.mapInArrow(run, schema)


def count_hashes(docs: DataFrame, **columns: str) -> DataFrame:
    """gram (hash), c: occurrences of each two and three neighbouring words."""

    def make(lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        words, at = numbered(text, 2)
        two, three = gram_hashes(lang, words, at)
        inside = (at[:-2] > 0) & (at[1:-1] > 0)
        gram, c = np.unique(np.concatenate((two[inside], three[inside & (at[2:] > 0)])), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(c, pa.int64())], ["gram", "c"])

    return _by_slice(docs, make, "gram long, c long", **columns).groupBy("gram").agg(F.sum("c").alias("c"))


def frequent_hashes(docs: DataFrame, min_count: int, **columns: str) -> np.ndarray:
    """The bitmap of the grams of two and three words with ``min_count`` occurrences."""
    grams = count_hashes(docs, **columns).where(F.col("c") >= min_count)
    bit = F.shiftright("gram", HASH_BITS - _FILTER_LOG) + 1     # SQL's bitmaps count from 1
    words = grams.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    bitmap = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in words.toLocalIterator():   # at most FILTER_BITS / 32768 rows of 4096 bytes
        begin = (r.bucket - 1) * 4096
        bitmap[begin:begin + 4096] = np.frombuffer(r.bits, np.uint8)
    return bitmap


def _told(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes >> np.uint64(HASH_BITS - _FILTER_LOG)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def word_rows(docs: DataFrame, bitmap: np.ndarray, longest: int, **columns: str) -> DataFrame:
    """lang, gram, c: the longest gram of every word position if it has two words or more, equal ones of
    a slice added up; and the flow of every single word."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def make(lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        words, at = numbered(text, longest)
        two, three = (_told(shared.value, h) for h in gram_hashes(lang, words, at))
        places, counts = rows_of(at, two, three, longest)
        flow = np.bincount(places[0], counts, len(words)).astype(np.int64)
        long = places[1] > 0
        single = np.flatnonzero(flow)
        places = [np.concatenate((p[long], single if k == 0 else np.zeros_like(single))) for k, p in enumerate(places)]
        counts = np.concatenate((counts[long], flow[single]))
        # the end mark is no text; its number only stands for null
        strings = pa.array([b"", *words[1:]], pa.binary()).cast(pa.string())
        for i in range(0, len(counts), ROWS_OUT):
            some = slice(i, i + ROWS_OUT)
            gram = pc.binary_join_element_wise(*[strings.take(pa.array(p[some], mask=p[some] == 0)) for p in places],
                                               " ", null_handling="skip")
            yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(gram)), gram, pa.array(counts[some], pa.int64())], ["lang", "gram", "c"])

    return _by_slice(docs, make, "lang string, gram string, c long", **columns)


def count_grams(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, **columns: str) -> DataFrame:
    """lang, n, gram (words joined by a space), f: every word and every gram of 2 to ``longest``
    words with at least ``min_count`` occurrences."""
    rows = word_rows(docs, frequent_hashes(docs, min_count, **columns), longest, **columns)
    edges = rows.groupBy("lang", "gram").agg(F.sum("c").alias("c"))
    size = F.size(F.split("gram", " "))
    # an edge is complete: below min_count only its shorter grams go on
    last = F.when((size == longest) & (F.col("c") < min_count), size - 1).otherwise(size)
    flow = edges.select("lang", "gram", "c", F.explode(F.sequence(F.least(F.lit(2), size), last)).alias("n"))
    flow = flow.select("lang", "n", F.expr("substring_index(gram, ' ', n)").alias("gram"), "c")
    return flow.groupBy("lang", "n", "gram").agg(F.sum("c").alias("f")).where((F.col("n") == 1) | (F.col("f") >= min_count))


def _but_last(gram="gram"):
    return F.expr(f"substring_index({gram}, ' ', size(split({gram}, ' ')) - 1)")


def _but_first(gram="gram"):
    return F.expr(f"substr({gram}, instr({gram}, ' ') + 1)")


def unary_nodes(grams: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, node, f, came, goes: nodes whose whole flow comes by edge ``came`` and leaves by ``goes``."""
    edges = grams.where(F.col("n") == longest)
    nodes = grams.where(F.col("n") == longest - 1).select("lang", F.col("gram").alias("node"), "f")
    into = edges.select("lang", _but_first().alias("node"), "f", F.col("gram").alias("came"))
    out = edges.select("lang", _but_last().alias("node"), "f", F.col("gram").alias("goes"))
    return nodes.join(into, ["lang", "node", "f"]).join(out, ["lang", "node", "f"])


def compact(grams: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, path (all its words), f, edges: the paths of the graph of frequent edges, with the
    edges that no unary node joins to others as paths of their own."""
    links = stage(unary_nodes(grams, longest), "unary")
    edges = grams.where(F.col("n") == longest).select("lang", F.col("gram").alias("edge"), "f")
    # each edge of a chain points `far` edges back; pointers double until they reach the first edge
    inner = links.select("lang", F.col("goes").alias("edge"), F.col("came").alias("back"), F.lit(1).alias("far"))
    first = (links.select("lang", F.col("came").alias("edge")).join(inner.select("lang", "edge"), ["lang", "edge"], "left_anti")
             .select("lang", "edge", F.col("edge").alias("back"), F.lit(0).alias("far")))
    chain = stage(inner.unionByName(first), "chain")
    while True:
        over = chain.select("lang", F.col("edge").alias("back"), F.col("back").alias("further"), F.col("far").alias("more"))
        if not chain.join(over.where("more > 0"), ["lang", "back"], "left_semi").limit(1).count():
            break
        chain = stage(chain.join(over, ["lang", "back"]).select(
            "lang", "edge", F.col("further").alias("back"), (F.col("far") + F.col("more")).alias("far")), "chain")
    placed = edges.join(chain, ["lang", "edge"], "left").withColumn("back", F.coalesce("back", "edge"))
    ends = F.array_sort(F.collect_list(F.when(F.col("far") > 0, F.struct("far", F.substring_index("edge", " ", -1).alias("w")))))
    return (placed.groupBy("lang", F.col("back").alias("start")).agg(F.max("f").alias("f"), ends.alias("ends"))
            .select("lang", F.concat_ws(" ", F.array("start"), F.col("ends.w")).alias("path"), "f",
                    (F.size("ends") + 1).cast("long").alias("edges")))


def candidates(grams: DataFrame, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, a) of the grams that may be phrases: the edges, read off the paths, the nodes
    that lie in none, and the shorter grams; and which of them can explain shorter ones (all)."""
    paths = compact(grams, longest)
    w = F.split("path", " ")
    edge = (paths.select("lang", F.col("f").alias("a"), w.alias("w"), F.explode(F.sequence(F.lit(1), F.size(w) - longest + 1)).alias("i"))
            .select("lang", F.expr(f"array_join(slice(w, i, {longest}), ' ')").alias("phrase"), F.lit(longest).alias("k"), "a"))
    shorter = grams.where(F.col("n").between(2, longest - 1)).select("lang", F.col("gram").alias("phrase"), F.col("n").alias("k"), F.col("f").alias("a"))
    inside = paths.where("edges > 1").select("lang", w.alias("w"), F.explode(F.sequence(F.lit(2), F.size(w) - longest + 1)).alias("i"))
    inside = inside.select("lang", F.expr(f"array_join(slice(w, i, {longest - 1}), ' ')").alias("phrase"))
    return edge.unionByName(shorter.join(inside, ["lang", "phrase"], "left_anti")), edge.unionByName(shorter)


def collocations(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP, **columns: str) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language."""
    grams = stage(count_grams(docs, longest, min_count, **columns), "grams")
    totals = grams.where("n = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    longer, every = candidates(grams, longest)
    # the strongest longer candidate around each phrase
    parts = every.where("k > 2").select("lang", F.col("a").alias("around"), F.split("phrase", " ").alias("w"), F.explode(
        F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> struct(i, m))))")).alias("p"))
    around = (parts.select("lang", F.expr("array_join(slice(w, p.i, p.m), ' ')").alias("phrase"), "around")
              .groupBy("lang", "phrase").agg(F.max("around").alias("around")))
    wide = "decimal(20, 0)"
    kept = stage(longer.join(around, ["lang", "phrase"], "left").where(
        F.expr(f"around IS NULL OR 100 * CAST(around AS {wide}) < {COVERED} * CAST(a AS {wide})")).drop("around"), "phrases")
    cuts = kept.select("lang", "phrase", "a", F.split("phrase", " ").alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.expr("array_join(slice(w, 1, cut), ' ')").alias("left"),
                       F.expr("array_join(slice(w, cut + 1, size(w)), ' ')").alias("right"))
    known = grams.where((F.col("n") < longest) & (F.col("f") >= min_count))
    scored = (cuts.join(known.select("lang", F.col("gram").alias("left"), F.col("f").alias("l")), ["lang", "left"])
              .join(known.select("lang", F.col("gram").alias("right"), F.col("f").alias("r")), ["lang", "right"])
              .withColumn("score", F.expr(f"({SCALE} * CAST(a AS {wide})) div (CAST(l AS {wide}) + CAST(r AS {wide}))")))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "best.l", "best.r", "n", "best.score")
