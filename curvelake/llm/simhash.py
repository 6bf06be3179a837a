"""SimHash near-duplicates by a vantage-point tree.

1. ``fingerprints``: 64-bit SimHash of word shingles, one row per document.
2. ``links``: pairs of different fingerprints within ``max_bits``.  The top of a
   vantage-point tree, grown on a bounded sample of fingerprints, deals all fingerprints
   over shards.  A fingerprint has one home shard; it is also sent, as a query only, to
   every shard that its search ball may reach (triangle bound), so no pair is lost at a
   border.  In a shard the same partition goes on over distances, down to small leaves that
   are compared directly.  Each shard returns a spanning star of each group it finds, not
   its pairs.
3. ``components``: smallest doc_id reachable over links (large star / small star rounds).

Defined results: a null text counts as empty; a text without words has fingerprint zero and
is linked like any other; rows that repeat a doc_id are rows of their own; a null doc_id
takes part in links but is not chosen as component_id unless the whole component has none
(component_id null).  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import free_name, schema_of, stage

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
SHARD_ROWS = 50_000        # fingerprints that a shard is meant to be home to
SAMPLE_ROWS = 1 << 16      # most fingerprints that the driver grows the top of the tree on
QUERIES_PER_ROW = 8        # queries in a block for each row of its shard
LEAF_ROWS = 64             # below this an index leaf is compared directly
BLOCK_CELLS = 1 << 22      # most cells of one direct comparison
HASH_BLOCK = 1 << 15       # shingles whose bits are counted at once


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of one UTF-8 text: A-Z lower-cased, ASCII white space separates words."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[: 1 - shingle_words or None].tolist(), ends[shingle_words - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(first), HASH_BLOCK):
        block = [xxh64_intdigest(joined[a:b], SEED) for a, b in
                 zip(first[i:i + HASH_BLOCK], last[i:i + HASH_BLOCK], strict=True)]
        octets = np.array(block, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(first)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                      text: str = "text", column: str = "fp") -> DataFrame:
    """All columns of ``docs`` and the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = [fingerprint(t.encode() if t else b"", shingle_words)
                      for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            out = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns, out], [*b.schema.names, column])

    return docs.mapInArrow(run, f"{schema_of(docs)}, `{column}` long")


# --- the tree ---------------------------------------------------------------

def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def grow(sample: np.ndarray, depth: int) -> dict:
    """The top of the tree: vantage point and radius per node, halves of about one size."""
    if depth == 0 or len(sample) < 2:
        return {}
    point = sample[len(sample) // 2]
    d = _distance(sample, point)
    radius = int(np.median(d))
    near = d <= radius
    if near.all():
        return {}
    return {"point": point, "radius": radius,
            "near": grow(sample[near], depth - 1), "far": grow(sample[~near], depth - 1)}


def route(tree: dict, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position in fps, shard, whether home) for every shard that a fingerprint's ball reaches."""
    out: list[tuple[np.ndarray, int, np.ndarray]] = []
    shard = 0

    def visit(node: dict, rows: np.ndarray, home: np.ndarray) -> None:
        nonlocal shard
        if not node:
            out.append((rows, shard, home))
            shard += 1
            return
        d = _distance(fps[rows], node["point"])
        near, far = d - max_bits <= node["radius"], d + max_bits > node["radius"]
        inside = d <= node["radius"]
        visit(node["near"], rows[near], home[near] & inside[near])
        visit(node["far"], rows[far], home[far] & ~inside[far])

    visit(tree, np.arange(len(fps)), np.ones(len(fps), bool))
    return (np.concatenate([r for r, _, _ in out]),
            np.concatenate([np.full(len(r), s, np.int32) for r, s, _ in out]),
            np.concatenate([h for _, _, h in out]))


def near_pairs(index: np.ndarray, queries: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (index, query) within ``max_bits``, found by a vantage-point partition.

    A node sorts its index points by their distance to a vantage point; queries follow only
    into distances within ``max_bits`` of their own (triangle inequality).
    """
    todo = [(index, queries, 0)]
    while todo:
        index, queries, failed = todo.pop()
        if not len(index) or not len(queries):
            continue
        if len(index) > LEAF_ROWS and failed < 4:
            point = index[(len(index) * (2 * failed + 1)) // 8]
            di, dq = _distance(index, point), _distance(queries, point)
            bands = np.unique(di)
            if len(bands) == 1:
                todo.append((index, queries[np.abs(dq - bands[0]) <= max_bits], failed + 1))
            else:
                todo += [(index[di == d], queries[np.abs(dq - d) <= max_bits], 0) for d in bands]
            continue
        step = max(1, BLOCK_CELLS // len(index))
        for i in range(0, len(queries), step):
            q = queries[i:i + step]
            at_q, at_i = np.nonzero(np.bitwise_count(q[:, None] ^ index[None, :]) <= max_bits)
            yield index[at_i], q[at_q]


def star_edges(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[list[int], list[int]]:
    """Spanning stars (node, root) of the groups that the pairs form."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    for a, b in pairs:
        other = a != b
        for x, y in zip(a[other].tolist(), b[other].tolist(), strict=True):
            rx, ry = find(x), find(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
    nodes = [x for x in parent if find(x) != x]
    return nodes, [find(x) for x in nodes]


def links(fps: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(u, v): links that join all of the distinct signed longs in ``fps.fp`` within ``max_bits``.

    The driver holds a sample of at most SAMPLE_ROWS fingerprints, never all of them.
    """
    n = fps.count()
    depth = min(max(0, int(np.ceil(np.log2(max(1, n / shard_rows))))), int(np.log2(SAMPLE_ROWS)) - 4)
    picked = [] if depth == 0 else fps.orderBy(F.xxhash64("fp"), "fp").limit(min(SAMPLE_ROWS, 256 << depth)).collect()
    tree = grow(np.array([r.fp for r in picked], np.int64).view(np.uint64), depth)
    # a ball reaches about 1.5 children of a node, so queries outnumber a shard's own rows as
    # the tree grows; they come in blocks, and the shard's rows go to each block
    blocks = int(np.ceil(1.5 ** depth / QUERIES_PER_ROW))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            rows, shard, home = route(tree, values.view(np.uint64), max_bits)
            fp, own = values[rows], np.flatnonzero(home)
            block = (fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % blocks
            at = np.concatenate((np.arange(len(rows)), np.repeat(own, blocks)))
            to = np.concatenate((block, np.tile(np.arange(blocks), len(own)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[at]), pa.array(to), pa.array(fp[at]), pa.array(np.arange(len(at)) >= len(rows))],
                ["shard", "block", "fp", "index"])

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        fp, index = pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["index"].to_numpy(bool)
        u, v = star_edges(near_pairs(fp[index], fp[~index], max_bits))
        return pd.DataFrame({"u": np.array(u, np.uint64).view(np.int64), "v": np.array(v, np.uint64).view(np.int64)})

    dealt = fps.select("fp").mapInArrow(deal, "shard int, block int, fp long, index boolean")
    return dealt.groupBy("shard", "block").applyInPandas(search, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node of ``edges`` (u, v), root the smallest node reachable.

    Alternating large-star and small-star rounds; each round is staged, and the loop ends
    when a round changes nothing (a star per component).
    """
    def least(e: DataFrame) -> DataFrame:
        # staged: both sides of the join back are then plain exchanges, and a hub is split
        return stage(e.groupBy("u").agg(F.min("v").alias("m")), "least")

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
              .where("u != v").distinct(), "links")
    before = state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(least(both), "u").select("u", "v", F.least("u", "m").alias("m"))
                 .where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.join(least(large), "u")
        small = (low.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))).distinct()
        e = stage(small, "stars")
        now = state(e)
        if now == before:
            break
        before = now
    return e.select("u", F.col("v").alias("root"))


def classes(prints: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``prints.fp``; roots stand for components."""
    distinct = stage(prints.groupBy("fp").agg(F.count("*").alias("n")), "prints")
    found = components(links(distinct.select("fp"), max_bits, shard_rows))
    return (distinct.join(found, distinct.fp == found.u, "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs`` (doc_id, text)."""
    prints = stage(with_fingerprints(docs.select("doc_id", "text"), shingle_words)
                   .select("doc_id", "fp"), "simhash")
    roots = stage(classes(prints, max_bits, shard_rows), "classes")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")).join(roots, "fp")
    ids = least.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = roots.join(ids, "root").select("fp", "component_id")
    return (prints.join(named, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
             shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the smallest doc_id
    stays (a null one only if there is no other), once, with all columns."""
    columns, mark = docs.columns, free_name(docs, "_fp")
    marked = stage(with_fingerprints(docs, shingle_words, column=mark), "marked")
    prints = marked.select(F.col(mark).alias("fp"), "doc_id")
    roots = stage(classes(prints, max_bits, shard_rows), "classes")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "fp")
    least = prints.groupBy("fp").agg(F.min(order).alias("o")).join(roots, "fp")
    keeper = least.groupBy("root").agg(F.min("o").alias("o")).select("o.doc_id", "o.fp")
    kept = marked.join(keeper, marked["doc_id"].eqNullSafe(keeper["doc_id"]) & (marked[mark] == keeper["fp"]),
                       "left_semi")
    return kept.dropDuplicates(["doc_id", mark]).select(*columns)
