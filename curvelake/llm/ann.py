"""Approximate nearest neighbours: an HNSW graph per shard, shard results merged.

Vectors are dealt over shards of about SHARD_ROWS by a hash of their values.  Every row is
indexed, except that of equal vectors only the ``k + 1`` smallest ids are needed: no answer of
``k`` can hold more of them, so a vector that a third of all rows share stays one node.  A
shard's graph is built in batches: a batch is searched in the graph so far, its members are
also compared with each other, and each keeps diverse neighbours (a candidate nearer to a
neighbour already kept than to the node is left out).  The graph is stored as one row of flat
arrays: ids, vectors, and per layer a fixed number of neighbours per node (-1: none).

Queries go to every shard in blocks; a shard answers with exact distances in double precision
on the original vectors, and the best ``k`` over all shards are the result.  Distances of
nodes that the beam has found are exact, so only which candidates are found is approximate
(recall is measured in the tests).

Defined results: a vector that is null, empty, all zero, or holds a null or non-finite
component takes no part, neither does a row without vec_id; rows that agree in vec_id and
vector count once; a row with the query's vec_id is never its neighbour; vectors are compared
only with vectors of their length.  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvelake.llm.common import stage

SHARD_ROWS = 8192
QUERY_BLOCK = 1024
M = 16                     # neighbours a node may keep on upper layers; twice that below
EF_BUILD = 64
EF_UPPER = 16
EF_SEARCH = 192
WIDTH = 4                  # nodes that a beam expands at once
BATCH = 256


# --- the graph of one shard ---------------------------------------------------

def beam(x: np.ndarray, layer: np.ndarray, queries: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """Best ``ef`` nodes of a layer for each query, nearest first (-1: none), and their
    squared distances; ``entry`` has start nodes per query."""
    n_q, rows = len(queries), np.arange(len(queries))[:, None]
    seen = np.zeros((n_q, len(x) + 1), bool)
    claim = np.zeros((n_q, len(x) + 1), np.int32)
    seen[:, -1] = True
    ids, dist = np.full((n_q, ef), -1, np.int32), np.full((n_q, ef), np.inf, np.float32)
    opened = np.ones((n_q, ef), bool)
    fresh = entry
    while True:
        order = np.broadcast_to(np.arange(fresh.shape[1], dtype=np.int32), fresh.shape)
        claim[rows, fresh] = order
        new = ~seen[rows, fresh] & (claim[rows, fresh] == order)
        seen[rows, fresh] = True
        gap = x[fresh] - queries[:, None, :]
        far = np.where(new, np.einsum("qmd,qmd->qm", gap, gap), np.inf).astype(np.float32)
        ids = np.concatenate((ids, np.where(new, fresh, -1)), axis=1)
        dist = np.concatenate((dist, far), axis=1)
        opened = np.concatenate((opened, ~new), axis=1)
        best = np.argpartition(dist, ef - 1, axis=1)[:, :ef]
        ids, dist, opened = ids[rows, best], dist[rows, best], opened[rows, best]
        left = np.where(opened, np.inf, dist)
        at = np.argpartition(left, min(WIDTH, ef - 1), axis=1)[:, :WIDTH]
        go = np.isfinite(left[rows, at])
        if not go.any():
            break
        fresh = np.where(go[:, :, None], layer[np.where(go, ids[rows, at], -1)], -1).reshape(n_q, -1)
        opened[rows, at] = True
    order = np.argsort(dist, axis=1, kind="stable")
    return np.where(np.isfinite(dist), ids, -1)[rows, order], dist[rows, order]


def diverse(x: np.ndarray, node: np.ndarray, cand: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each node's candidates (-1: none): nearest first, leaving out those
    nearer to one already kept than to the node; free places go to the nearest left out."""
    gap = x[cand] - x[node][:, None, :]
    d = np.where(cand >= 0, np.einsum("qmd,qmd->qm", gap, gap), np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, : 3 * most]
    cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
    cand = np.where(np.isfinite(d), cand, -1)
    own = x[cand]
    sq = np.einsum("qmd,qmd->qm", own, own)
    between = sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(own, own.transpose(0, 2, 1))
    kept = np.zeros(cand.shape, bool)
    for j in range(cand.shape[1]):
        covered = (kept & (between[:, j, :] < d[:, j, None])).any(axis=1)
        kept[:, j] = np.isfinite(d[:, j]) & ~covered & (kept.sum(axis=1) < most)
    rank = np.argsort(np.where(kept, 0, 1) + np.where(cand >= 0, 0, 2), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(cand, rank, 1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def build(x: np.ndarray, seed: int = 0) -> list[np.ndarray]:
    """Layers of the graph of ``x``, whose rows are in order of insertion: the arrays
    (n + 1, neighbours), the last row empty so that index -1 has no neighbours."""
    n = len(x)
    level = np.sort((-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(M)).astype(int))[::-1]
    layers = [np.full((n + 1, 2 * M if i == 0 else M), -1, np.int32) for i in range(int(level[0]) + 1 if n else 1)]
    padded = np.concatenate((x, np.zeros((1, x.shape[1]), x.dtype)))
    for begin in range(0, n, BATCH):
        batch = np.arange(begin, min(n, begin + BATCH))
        entry = np.zeros((len(batch), 1), np.int32)
        for at in range(len(layers) - 1, -1, -1):
            layer, here = layers[at], level[batch] >= at
            found = None
            if begin:
                found, _ = beam(padded, layer, x[batch], entry, EF_BUILD if at == 0 else EF_UPPER)
                entry = np.where(found[:, :4] >= 0, found[:, :4], found[:, :1])
            node = batch[here]
            if not len(node):
                continue
            sq = (x[node] ** 2).sum(axis=1)
            d = sq[:, None] + sq[None, :] - 2 * x[node] @ x[node].T
            np.fill_diagonal(d, np.inf)
            mates = np.argsort(d, axis=1, kind="stable")[:, : min(len(node) - 1, layer.shape[1])]
            cand = node[mates].astype(np.int32)
            if found is not None:
                cand = np.concatenate((cand, found[here]), axis=1)
            if not cand.shape[1]:
                continue
            layer[node] = diverse(padded, node, cand, layer.shape[1])
            _link_back(padded, layer, node)
    return layers


def _link_back(x: np.ndarray, layer: np.ndarray, node: np.ndarray) -> None:
    """Enter each of ``node`` with its neighbours, which keep diverse ones among all."""
    to = layer[node]
    source = np.repeat(node, to.shape[1])[to.ravel() >= 0]
    target = to.ravel()[to.ravel() >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    who, first, count = np.unique(target, return_index=True, return_counts=True)
    extra = np.full((len(who), count.max(initial=0)), -1, np.int32)
    extra[np.repeat(np.arange(len(who)), count), np.arange(len(target)) - np.repeat(first, count)] = source
    extra[(extra[:, :, None] == layer[who][:, None, :]).any(axis=2)] = -1
    full = (layer[who] >= 0).sum(axis=1) + (extra >= 0).sum(axis=1)
    for i in range(0, len(who), BATCH):
        part = slice(i, i + BATCH)
        both = np.concatenate((layer[who[part]], extra[part]), axis=1)
        both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, : max(1, full[part].max())]
        layer[who[part]] = diverse(x, who[part], both, layer.shape[1])


def search(x: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, ef: int) -> np.ndarray:
    """Node numbers found for each query (-1: none)."""
    padded = np.concatenate((x, np.zeros((1, x.shape[1]), x.dtype)))
    entry = np.zeros((len(queries), 1), np.int32)
    for layer in layers[:0:-1]:
        found, _ = beam(padded, layer, queries, entry, EF_UPPER)
        entry = np.where(found[:, :4] >= 0, found[:, :4], found[:, :1])
    return beam(padded, layers[0], queries, entry, min(ef, max(2, len(x))))[0]


# --- on Spark -----------------------------------------------------------------

def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part, each pair once."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    ok = F.col("vec_id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda e: e != 0)
    return vectors.where(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long"), v.alias("v")).distinct()


def build_index(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: dim, shard, and the flat arrays as bytes."""
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1).drop("nth")
    dealt = few.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.stack(pdf["v"].to_list()).astype(np.float64) + 0.0
        ids = pdf["vec_id"].to_numpy(np.int64)
        order = np.lexsort((ids, *values.T[::-1]))
        values, ids = values[order], ids[order]
        new = np.concatenate(([True], (values[1:] != values[:-1]).any(axis=1)))
        shuffled = np.random.default_rng(len(ids)).permutation(int(new.sum()))
        first = np.append(np.flatnonzero(new), len(ids))
        nodes = values[first[:-1]][shuffled]
        members = [ids[first[i]:first[i + 1]] for i in shuffled]
        layers = build(nodes.astype(np.float32))
        return pd.DataFrame([{
            "dim": values.shape[1], "shard": pdf["shard"].iloc[0], "n": len(nodes), "vectors": nodes.tobytes(),
            "ids": np.concatenate(members).tobytes(), "copies": np.array([len(m) for m in members], "<i4").tobytes(),
            "widths": [a.shape[1] for a in layers], "neighbours": [a.tobytes() for a in layers]}])

    return dealt.groupBy("dim", "shard").applyInPandas(
        make, "dim int, shard int, n int, vectors binary, ids binary, copies binary, widths array<int>, neighbours array<binary>")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, vector: str = "embedding",
            shard_rows: int = SHARD_ROWS, ef: int = EF_SEARCH) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``vectors`` found for each
    row of ``queries`` (both with vec_id and ``vector``), by Euclidean distance."""
    index = stage(build_index(stage(usable(vectors, vector), "vectors"), k, shard_rows), "hnsw")
    asked = stage(usable(queries, vector).withColumn("dim", F.size("v")), "queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    spread = (asked.withColumn("query", F.xxhash64("v"))
              .withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")))
    # the stated query set against all shards, in blocks
    shards = index.groupBy("dim").agg(F.collect_list("shard").alias("shards"))
    tasks = spread.join(shards, "dim").select("dim", F.explode("shards").alias("shard"), "block", "query", "vec_id", "v")
    copies = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [r for i in range(len(left)) for r in _answer(left.iloc[i], right, k, ef)] if len(right) else []
        return pd.DataFrame(out, columns=["query_id", "query", "vec_id", "score"])

    found = copies.groupBy("dim", "shard", "block").cogroup(tasks.groupBy("dim", "shard", "block")).applyInPandas(
        answer, "query_id long, query long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _answer(shard: pd.Series, asked: pd.DataFrame, k: int, ef: int) -> Iterator[tuple[int, int, int, float]]:
    nodes = np.frombuffer(shard["vectors"], np.float64).reshape(shard["n"], -1)
    copies = np.frombuffer(shard["copies"], "<i4")
    ids, first = np.frombuffer(shard["ids"], np.int64), np.concatenate(([0], np.cumsum(copies)))
    layers = [np.frombuffer(a, np.int32).reshape(-1, w) for a, w in zip(shard["neighbours"], shard["widths"], strict=True)]
    queries = np.stack(asked["v"].to_list()).astype(np.float64)
    keys = asked["query"].tolist()
    for i in range(0, len(queries), BATCH):
        found = search(nodes.astype(np.float32), layers, queries[i:i + BATCH].astype(np.float32), ef)
        for j, row in enumerate(found, i):
            row = row[row >= 0]
            score = np.sqrt(((nodes[row] - queries[j]) ** 2).sum(axis=1))
            own = int(asked["vec_id"].iloc[j])
            near = sorted((s, v) for s, r in zip(score.tolist(), row.tolist(), strict=True)
                          for v in ids[first[r]:first[r + 1]].tolist() if v != own)
            yield from ((own, keys[j], v, s) for s, v in near[:k])
