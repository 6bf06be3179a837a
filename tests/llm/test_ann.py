"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from curvelake.llm import ann
from curvelake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, v string, dim string, shard string"


def brute(rows, k=10):
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v and all(e is not None and math.isfinite(e) for e in v) and any(v)}
    out = {}
    for i, v in ok:
        if i % 100 == 0:
            near = sorted((float(np.sqrt(((np.array(w, float) - np.array(v, float)) ** 2).sum())), j)
                          for j, w in ok if j != i and len(w) == len(v))
            out[i] = [(j, s) for s, j in near[:k]]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


def recall(found, want):
    return np.mean([len({j for j, _ in found[q]} & {j for j, _ in want[q]}) / len(want[q]) for q in want if want[q]])


def ask(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0, "", "", "") for i, v in rows], SCHEMA).repartition(4)
    return got(ann.nearest(df, df.where("vec_id % 100 = 0"), **kw))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_whole_table(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    want, found = brute(rows), got(QUERIES["op8_ann"](spark, path))
    assert set(found) == set(want) and recall(found, want) >= 0.97
    exact = {(q, j): s for q in want for j, s in want[q]}
    for q in found:
        assert found[q] == sorted(found[q], key=lambda r: (r[1], r[0]))
        assert all(abs(exact.get((q, j), s) - s) < 1e-12 for j, s in found[q])


def test_random_vectors_in_shards(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=24).astype(np.float32).tolist()) for i in range(6000)]
    want, found = brute(rows), ask(spark, rows, shard_rows=1500)
    assert recall(found, want) >= 0.95


def test_copies_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(0, 2, 6).astype(float).tolist()) for i in range(400)]   # many ties
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(300)]
    rows += [(2000, None), (2100, [0.0] * 6), (2200, [float("nan")] * 6), (2300, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2400, []),
             (2500, [float("inf"), 0.0, 0.0, 0.0, 0.0, 1.0]), (None, [1.0] * 6), (2600, [1.0, 2.0]), (2700, [-0.0, 1.0]), (2601, [0.0, 1.0]),
             rows[0], rows[0], (2800, [5.0] * 9)]
    want = brute(rows)
    found = ask(spark, rows)
    assert {q: v for q, v in want.items() if v} == found


def test_empty(spark):
    assert ask(spark, []) == {}
