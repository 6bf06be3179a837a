"""Hard-negative mining with rotated one-bit codes.

Rows are vectors of integers (``floor(SCALE * x)``).  The index keeps for each row, beside the vector:

* its code: the signs of the vector after a seeded random rotation, one bit each;
* the alignment ``s``, the vector's exact inner product with its code as a unit vector;
* the residual ``r``, the length of what the code does not explain.

For an anchor ``q`` with inner product ``g`` with a row's code, the row's score lies in
``s * g ± r * sqrt(|q|² - g²)`` by Cauchy-Schwarz, as what is left of both is orthogonal to the code.
``g`` itself is estimated by popcounts: the rotated anchor is rounded to PLANES bits, each plane is
combined with the codes, and the rounding error widens the interval.  So every interval holds the
score.  The PROBES rows with the best intervals are scored first; rows whose interval can't reach the
answer that these give are left out, and the surviving ones are scored in integers, once for all ranges
asked for.  GROUP anchors are scored together: where their survivors are many, as a matrix product in the
smallest type of number that holds every sum of it exactly.

Two passes over the index, the second with what the first found:

1. positives: an anchor's best rows of its label;
2. negatives: for each positive the best rows of other labels with a score in its range.

A task takes index rows in chunks of CHUNK_ROWS, sorted by label, and reads the anchors from the staged files in the
shared folder block by block, so neither index nor anchors cross a shuffle and memory stays bounded.
A chunk answers with at most ``positives`` (``negatives``) rows per anchor (and positive), which is
enough, whatever share of the rows one label holds; the best of all chunks are the result.

Defined results: a row without vec_id, label or vector, with an empty vector or with a null or
non-finite component takes no part, neither does one whose squared length passes 64 bits (all
other scores fit a long); rows that agree in vec_id, label and vector count once, other rows of one
vec_id are rows of their own; a row with the anchor's vec_id is never its positive or negative; vectors
are compared only with vectors of their length; ties go to the smaller vec_id.  Extra columns (very
long texts too) are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.llm.common import run_folder, stage, worker_cache

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LEAST, MOST = 50, 95       # a negative's score in per cent of the positive's
CHUNK_ROWS = 16_384
ANCHOR_ROWS = 512          # anchors of a block
PLANES = 8
PROBES = 32                # rows scored first, whose k-th score the others must reach
GROUP = 64                 # anchors scored together
DENSE = 8                  # a group is scored as a whole if its survivors are more than one in so many
SLACK = 1e-9               # of the product of both lengths: rounding in floating point
ANY = (-(1 << 63) + 1, (1 << 63) - 1)      # the range of all scores


# --- codes and intervals --------------------------------------------------------

def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    kept = worker_cache("rotations")
    if dim not in kept:
        q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
        kept[dim] = q * np.sign(np.diag(r))
    return kept[dim]


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.zeros((len(bits), -(-bits.shape[1] // 64) * 8), np.uint8)
    packed[:, :-(-bits.shape[1] // 8)] = np.packbits(bits, axis=1, bitorder="little")
    return packed.view(np.uint64)


def _ones(code: np.ndarray, plane: np.ndarray | None = None) -> np.ndarray:
    """Bits set in each row's words (and in the plane's)."""
    total = 0
    for k in range(code.shape[1]):
        ones = np.bitwise_count(code[:, k] if plane is None else code[:, k] & plane[k])
        total = ones if code.shape[1] == 1 else total + ones.astype(np.int32)
    return total


def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code words, alignment and residual length of each row."""
    turned = vectors.astype(np.float64) @ rotation(vectors.shape[1])
    align = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return _words(turned >= 0), align, np.sqrt(np.maximum((turned ** 2).sum(axis=1) - align ** 2, 0))


class Anchor:
    """A query vector, rotated and rounded to bit planes."""

    def __init__(self, vector: np.ndarray):
        self.vector = vector
        turned = vector.astype(np.float64) @ rotation(len(vector))
        self.length = float(np.sqrt((turned ** 2).sum()))
        self.low, self.sum, self.root = float(turned.min()), float(turned.sum()), float(np.sqrt(len(vector)))
        self.step = (float(turned.max()) - self.low) / (2 ** PLANES - 1) or 1.0
        level = np.rint((turned - self.low) / self.step).astype(np.int64)
        self.planes = _words((level >> np.arange(PLANES)[:, None] & 1).astype(bool))

    def interval(self, code: np.ndarray, align: np.ndarray, rest: np.ndarray, ones: np.ndarray | None = None,
                 length: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the scores of rows, by popcounts and Cauchy-Schwarz; ``ones`` and ``length`` of the rows, if known."""
        ones = _ones(code).astype(np.float64) if ones is None else ones
        length = np.hypot(align, rest) if length is None else length
        level = np.zeros(len(code), np.int32)
        for plane in self.planes[::-1]:
            level += level
            level += _ones(code, plane)
        off = (self.step / self.root) * ones     # half a step for each one, twice
        g = (2 * self.low / self.root) * ones + (2 * self.step / self.root) * level - self.sum / self.root
        around = np.maximum(np.abs(g) - off, 0)
        around = np.sqrt(np.maximum(self.length ** 2 - around * around, 0))
        wide = align * off + rest * around + (SLACK * self.length) * length + SLACK
        g *= align
        return g - wide, g + wide


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value, or minus infinity if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def narrow(chunk: Chunk, at: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, k: int,
           ranges: list[tuple[int, int]]) -> np.ndarray:
    """Which of the rows ``at`` may be among the best ``k`` of one of the ``ranges`` (least and most score);
    ``low`` and ``high`` bound their scores and are minus infinity for rows that take no part."""
    # the rows that look best in the lowest range are scored first: what can't reach the k-th of them is out
    middle = low + high
    middle[middle > 2 * min(most for _, most in ranges)] = -np.inf
    probe = np.argpartition(middle, len(at) - min(PROBES, len(at)))[-PROBES:]
    probe = probe[high[probe] > -np.inf]
    score = (chunk.vectors[at[probe]] @ anchor).astype(np.int64)
    reach = min(max(least, _kth(score[(score >= least) & (score <= most)], k)) for least, most in ranges)
    return (high >= reach) & (low <= max(most for _, most in ranges))


def pick(ids: np.ndarray, score: np.ndarray, k: int, ranges: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """(vec_id, score) of the best ``k`` in each of the ``ranges``."""
    # what the lowest range's best reach is enough for the ranges that end above it
    least = max(min(least for least, _ in ranges), _kth(score[score <= min(most for _, most in ranges)], k))
    fits = np.flatnonzero((score >= least) & (score <= max(most for _, most in ranges)))
    ids, score = ids[fits], score[fits]
    order = np.lexsort((ids, -score))
    ids, score = ids[order], score[order]
    out = []
    for least, most in ranges:
        begin, end = np.searchsorted(-score, -most, "left"), np.searchsorted(-score, -least, "right")
        at = slice(begin, min(end, begin + k))
        out.append(list(zip(ids[at].tolist(), score[at].tolist(), strict=True)))
    return out


def best(chunk: Chunk, at: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, k: int,
         least: int = ANY[0], most: int = ANY[1]) -> list[tuple[int, int]]:
    """(vec_id, score) of the best ``k`` of the rows ``at``, with scores from ``least`` to ``most``;
    ``low`` and ``high`` bound their scores. One anchor alone; ``Chunk.search`` takes many."""
    if len(at) == 0:
        return []
    at = at[narrow(chunk, at, low, high, anchor, k, [(least, most)])]
    return pick(chunk.ids[at], chunk.vectors[at] @ anchor, k, [(least, most)])[0]


class Chunk:
    """Index rows of one vector length as arrays, sorted by label."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, code: np.ndarray, align: np.ndarray, rest: np.ndarray):
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels, self.vectors, self.align, self.rest = ids[order], labels[order], vectors[order], align[order], rest[order]
        self.code = np.asfortranarray(code[order])          # each word's column in one piece
        self.ones, self.length = _ones(self.code).astype(np.float64), np.hypot(self.align, self.rest)
        self.typed: dict = {}

    @classmethod
    def of(cls, table: pa.Table, dim: int) -> Chunk:
        return cls(table["vec_id"].to_numpy(), table["label"].to_numpy(), _matrix(table["v"], dim),
                   _matrix(table["code"], -(-dim // 64)).view(np.uint64), table["align"].to_numpy(), table["rest"].to_numpy())

    def part(self, at: slice, length: float) -> Chunk:
        """Rows of it, for anchors of this length at most: with vectors of the smallest type of number in which
        scores are exact (no partial sum passes the product of both lengths)."""
        part = copy.copy(self)
        most = 2 * length * float(self.length.max(initial=0))
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
        if kind not in self.typed:
            self.typed[kind] = self.vectors.astype(kind, copy=False)
        part.vectors = self.typed[kind][at]
        for name in ("ids", "labels", "code", "align", "rest", "ones", "length"):
            setattr(part, name, getattr(self, name)[at])
        return part

    def search(self, anchors: list[Anchor], closed: list[np.ndarray], k: int,
               ranges: list[list[tuple[int, int]]]) -> Iterator[list[list[tuple[int, int]]]]:
        """For each anchor the best ``k`` in each of its ``ranges``, without the rows ``closed`` to it."""
        at = np.arange(len(self.ids))
        for begin in range(0, len(anchors), GROUP):
            group = range(begin, min(begin + GROUP, len(anchors)))
            vectors = np.array([anchors[n].vector for n in group]).astype(self.vectors.dtype)
            alive = np.zeros((len(group), len(at)), bool)
            for row, vector, n in zip(alive, vectors, group, strict=True):
                low, high = anchors[n].interval(self.code, self.align, self.rest, self.ones, self.length)
                low[closed[n]] = high[closed[n]] = -np.inf
                row[:] = narrow(self, at, low, high, vector, k, ranges[n])
                row[closed[n]] = False
            # many survivors: all rows for the group at once cost less than copies of each anchor's
            scores = vectors @ self.vectors.T if DENSE * int(alive.sum()) > alive.size else None
            for m, n in enumerate(group):
                left = np.flatnonzero(alive[m])
                score = scores[m][left] if scores is not None else self.vectors[left] @ vectors[m]
                yield pick(self.ids[left], score.astype(np.int64), k, ranges[n])


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).reshape(-1, width)


# --- on Spark -------------------------------------------------------------------

def usable(vectors: DataFrame, vector: str, label: Column) -> DataFrame:
    """vec_id, label, v (integers): the rows that take part, equal ones once."""
    x = F.transform(F.col(vector).cast("array<double>"), lambda e: e * F.lit(float(SCALE)))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    long = F.aggregate(x, F.lit(0.0), lambda total, e: total + (F.abs(e) + 1) * (F.abs(e) + 1)) >= float(1 << 63)
    ok = F.col("vec_id").isNotNull() & label.isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~bad & ~long
    rows = vectors.where(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), x.alias("x"))
    return rows.select("vec_id", "label", F.transform("x", lambda e: F.floor(e)).alias("v")).distinct()


def build_index(rows: DataFrame) -> DataFrame:
    """The rows with code, align and rest, staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                some = b.filter(pa.array(dims == dim))
                code, align, rest = codes(some.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
                ends = np.arange(0, code.size + 1, code.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(code.view(np.int64).ravel())),
                     pa.array(align), pa.array(rest)], ["vec_id", "label", "v", "code", "align", "rest"])

    return stage(rows.mapInArrow(run, "vec_id long, label long, v array<long>, code array<long>, align double, rest double"), "codes")


def _to_shared(df: DataFrame, name: str) -> str:
    """``df`` as Parquet files in the shared folder."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return path


def _blocks(path: str) -> Iterator[pa.RecordBatch]:
    """The rows of a staged table, ANCHOR_ROWS at once."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    files = store.get_file_info(fs.FileSelector(root))
    for f in sorted(f.path for f in files if f.path.endswith(".parquet")):
        with store.open_input_file(f) as source:
            yield from pq.ParquetFile(source).iter_batches(ANCHOR_ROWS)


def _asked(block: pa.RecordBatch, dim: int) -> tuple[list[dict], list[Anchor]]:
    """A block's anchors of one vector length, by label: their other columns, and the anchors."""
    at = block.column("v").value_lengths().to_numpy(zero_copy_only=False) == dim
    some = block.filter(pa.array(at)).sort_by("label")
    vectors = some.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return some.drop_columns(["v"]).to_pylist(), [Anchor(v) for v in vectors]


def _ask(index: DataFrame, anchors: str, answer: Callable[[Chunk, list[dict], list[Anchor]], Iterator[tuple]], columns: list[str]) -> DataFrame:
    """``answer`` for every block of anchors and chunk of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ask(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            dims = table["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                chunk = Chunk.of(table.filter(pa.array(dims == dim)), dim)
                for block in _blocks(anchors):
                    asked, qs = _asked(block, dim)
                    out = list(answer(chunk, asked, qs)) if asked else []
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], columns)

        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= CHUNK_ROWS:
                yield from ask(held)
                held, n = [], 0
        if held:
            yield from ask(held)

    return index.mapInArrow(run, ", ".join(f"{c} long" for c in columns))


def same_label(chunk: Chunk, asked: list[dict], anchors: list[Anchor], k: int) -> Iterator[tuple]:
    """(key, vec_id, positive, score): the best ``k`` rows of each anchor's label. The anchors come by label."""
    labels = [a["label"] for a in asked]
    for label in dict.fromkeys(labels):
        here = slice(labels.index(label), labels.index(label) + labels.count(label))
        at = slice(np.searchsorted(chunk.labels, label, "left"), np.searchsorted(chunk.labels, label, "right"))
        if at.start == at.stop:
            continue
        part = chunk.part(at, max(q.length for q in anchors[here]))
        own = [part.ids == a["vec_id"] for a in asked[here]]
        for a, (found,) in zip(asked[here], part.search(anchors[here], own, k, [[ANY]] * len(own)), strict=True):
            yield from ((a["key"], a["vec_id"], *r) for r in found)


def other_labels(chunk: Chunk, asked: list[dict], anchors: list[Anchor], k: int, least: int, most: int) -> Iterator[tuple]:
    """(key, vec_id, nth, positive, positive's score, negative, score): for each of an anchor's positives the best
    ``k`` rows of other labels with ``least`` to ``most`` per cent of its score."""
    part = chunk.part(slice(None), max(q.length for q in anchors))
    closed = [(part.labels == a["label"]) | (part.ids == a["vec_id"]) for a in asked]
    scores = [[p["positive_score"] for p in a["positives"]] for a in asked]
    ranges = [[(min(-(-least * s // 100), ANY[1]), min(most * s // 100, ANY[1])) for s in some] for some in scores]
    for a, found in zip(asked, part.search(anchors, closed, k, ranges), strict=True):
        for p, rows in zip(a["positives"], found, strict=True):
            yield from ((a["key"], a["vec_id"], p["nth"], p["positive_id"], p["positive_score"], *r) for r in rows)


def hard_negatives(vectors: DataFrame, anchor: Column, vector: str = "embedding", label: Column | None = None,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row that ``anchor``
    (a condition on vec_id) holds for and each of its first ``positives`` rows of the same ``label``, the first
    ``negatives`` rows of other labels with ``least`` to ``most`` per cent of the positive's score."""
    index = build_index(usable(vectors, vector, F.col("label") if label is None else label))
    key = F.xxhash64("vec_id", "label", "v").alias("key")
    anchors = index.where(anchor).select(key, "vec_id", "label", "v")

    def first(chunk: Chunk, asked: list[dict], qs: list[Anchor]) -> Iterator[tuple]:
        return same_label(chunk, asked, qs, positives)

    found = _ask(index, _to_shared(anchors, "anchors"), first, ["key", "anchor_id", "positive_id", "positive_score"])
    nth = F.row_number().over(Window.partitionBy("key", "anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    near = stage(found.withColumn("nth", nth).where(F.col("nth") <= positives), "positives")
    # negative scores have no range below zero: `least` per cent would be above `most` per cent
    pairs = near.where("positive_score >= 0").groupBy("key", F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("nth", "positive_id", "positive_score")).alias("positives"))

    def second(chunk: Chunk, asked: list[dict], qs: list[Anchor]) -> Iterator[tuple]:
        return other_labels(chunk, asked, qs, negatives, least, most)

    names = ["key", "anchor_id", "nth", "positive_id", "positive_score", "negative_id", "negative_score"]
    asked = _to_shared(anchors.join(pairs, ["key", "vec_id"]), "pairs")
    hard = _ask(index, asked, second, names)
    rank = F.row_number().over(Window.partitionBy("key", "anchor_id", "nth").orderBy(F.desc("negative_score"), "negative_id"))
    return hard.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
