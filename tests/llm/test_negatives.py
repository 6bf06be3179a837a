"""Hard negatives against plain Python integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from curvelake.llm import negatives
from curvelake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, v string, code string, key string"


def brute(rows, every=50):
    """The contract on (vec_id, vector, label)."""
    ok = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(e is None or not math.isfinite(e) for e in v):
            continue
        v = tuple(math.floor(256 * e) for e in v)
        if sum(e * e for e in v) < 1 << 62:
            ok[i, label, v] = 1
    out = []
    for i, label, v in ok:
        if i % every:
            continue
        score = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in ok if j != i and len(w) == len(v)]
        for p, j, _ in sorted(s for s in score if s[2] == label)[:5]:
            near = sorted(s for s in score if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p)[:3]
            out += [(i, j, k, n, -p, -s) for k, (s, n, _) in enumerate(near, 1)]
    return sorted(out)


def changed(rows):
    return [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]


def mine(spark, rows):
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(4)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 50 == 0).collect())


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_whole_table(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    found = QUERIES["op13_negatives"](spark, path)
    assert found.schema["rank"].dataType.simpleString() == "int"
    assert sorted(tuple(r) for r in found.collect()) == brute(changed(rows))


def test_intervals_hold_the_score():
    rng = np.random.default_rng(1)
    for dim in (1, 3, 64, 100):
        x = rng.integers(-300, 300, (500, dim)) * rng.integers(0, 3, (500, 1))
        code, align, rest = negatives.codes(x)
        for q in (*x[:20], np.zeros(dim, np.int64), x[0] * 10 ** 6):
            low, high = negatives.Anchor(q).interval(code, align, rest)
            score = x @ q
            assert (low <= score).all() and (score <= high).all()


def test_codes_leave_rows_out():
    """Of rows around eight centres those of other centres are not scored, and the best stay."""
    rng = np.random.default_rng(2)
    x = np.floor(256 * (rng.normal(size=(8, 64))[rng.integers(0, 8, 2000)] + 0.1 * rng.normal(size=(2000, 64)))).astype(np.int64)
    q, scored = x[0], []

    class Rows(np.ndarray):
        def __getitem__(self, at):
            scored.append(len(at))
            return np.asarray(self)[at]

    chunk = type("C", (), {"ids": np.arange(2000), "vectors": x.view(Rows)})
    low, high = negatives.Anchor(q).interval(*negatives.codes(x))
    found = negatives.best(chunk, np.arange(2000), low, high, q, 5)
    assert found == sorted(((i, int(s)) for i, s in enumerate(x @ q)), key=lambda r: (-r[1], r[0]))[:5]
    assert sum(scored) < 700


def test_ties_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CHUNK_ROWS", 64)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 3)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(-1, 3, 5) / 2).tolist(), int(rng.integers(0, 3))) for i in range(400)]      # many ties
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0], 1) for i in range(150)]                                # a hot copy
    rows += [(2000, None, 1), (2050, [], 1), (2100, [0.0] * 5, 1), (2150, [float("nan")] * 5, 1), (2200, [1.0, None, 1.0, 1.0, 1.0], 1),
             (2250, [float("inf"), 0.0, 0.0, 0.0, 0.0], 2), (None, [1.0] * 5, 1), (2300, [1.0] * 5, None), (2350, [1.0, 2.0], 1),
             (2351, [1.0, 3.0], 1), (2352, [0.5, 1.0], 2), (2400, [1e300] * 5, 1), (2450, [5.0] * 9, 0), rows[0], rows[0],
             (50, [0.25] * 5, 2), (2500, [-1.0] * 5, 7), (2501, [0.5] * 5, 7)]
    assert mine(spark, rows) == brute(rows)


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(0, 1 << 20, 4) * 257.0).tolist(), i % 3) for i in range(300)]
    assert mine(spark, rows) == brute(rows)


def test_empty(spark):
    assert mine(spark, []) == []


def chunk_of(x, labels):
    return negatives.Chunk(np.arange(len(x)), labels, x, *negatives.codes(x))


def searched(x, labels, at):
    """Both searches of one chunk for the rows ``at``: positives, and negatives of all of them."""
    chunk, at = chunk_of(x, labels), sorted(at, key=lambda i: labels[i])
    asked, qs = [{"key": int(i), "vec_id": int(i), "label": int(labels[i])} for i in at], [negatives.Anchor(x[i]) for i in at]
    near = list(negatives.same_label(chunk, asked, qs, 5))
    for a in asked:
        mine = sorted((-s, p) for _, i, p, s in near if i == a["vec_id"] and s >= 0)
        a["positives"] = [{"nth": n, "positive_id": p, "positive_score": -s} for n, (s, p) in enumerate(mine, 1)]
    some = [n for n, a in enumerate(asked) if a["positives"]]
    found = negatives.other_labels(chunk, [asked[n] for n in some], [qs[n] for n in some], 3, 50, 95)
    return [(i, p, n, s, t) for _, i, _, p, s, n, t in found]


def plain(x, labels, at):
    rows = [(int(i), tuple((v / 256 for v in x[i].tolist())), int(labels[i])) for i in range(len(x))]
    return [(i, p, n, s, t) for i, p, _, n, s, t in brute(rows, 1) if i in at]


def test_an_anchor_is_searched_once_for_all_its_positives(monkeypatch):
    """Time is for pairs of anchor and row, not of positive and row: no anchor's rows are bounded or scored again."""
    rng = np.random.default_rng(6)
    x, labels, calls = rng.integers(-200, 200, (900, 64)), rng.integers(0, 3, 900), {"narrow": 0, "pick": 0}
    for name in calls:
        def counted(*args, name=name, real=getattr(negatives, name)):
            calls[name] += 1
            return real(*args)

        monkeypatch.setattr(negatives, name, counted)
    at = range(0, 900, 9)
    found = searched(x, labels, at)
    assert len({r[:2] for r in found}) > 300
    assert calls == {"narrow": 200, "pick": 200}
    assert sorted(found) == sorted(plain(x, labels, at))


@pytest.mark.parametrize(("size", "kind"), [(100, np.float32), (1 << 14, np.float64), (1 << 28, np.int64)])
@pytest.mark.parametrize("dense", [0, 10 ** 9])
def test_scores_are_exact_in_each_type(monkeypatch, size, kind, dense):
    monkeypatch.setattr(negatives, "GROUP", 7)
    monkeypatch.setattr(negatives, "DENSE", dense)       # each survivor alone, or all rows
    rng = np.random.default_rng(7)
    x = rng.integers(size // 2, size, (300, 4)) + np.where(rng.integers(0, 2, (300, 1)), 0, -size)
    x[150:] = x[:150] + rng.integers(-1, 2, (150, 4))    # scores that differ by little
    labels, at = rng.integers(0, 4, 300), range(0, 300, 5)
    assert chunk_of(x, labels).part(slice(None), float(np.sqrt((x.astype(float) ** 2).sum(axis=1).max()))).vectors.dtype == kind
    rows = [(i, [int(v) for v in x[i]], int(labels[i])) for i in range(300)]
    out = []
    for i, v, label in rows[::5]:
        score = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in rows if j != i]
        for p, j, _ in sorted(s for s in score if s[2] == label)[:5]:
            near = sorted(s for s in score if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p)[:3]
            out += [(i, j, n, -p, -s) for s, n, _ in near]
    assert out and sorted(searched(x, labels, at)) == sorted(out)


def test_few_rows_and_own_rows():
    """An anchor's own row is no probe where a label has fewer rows than are probed."""
    x = np.array([[9, 9], [1, 0], [2, 0], [3, 1], [-1, -1], [5, 2], [4, 4]])
    labels = np.array([1, 1, 1, 1, 1, 2, 2])
    chunk, asked = chunk_of(x, labels), [{"key": 0, "vec_id": 0, "label": 1}, {"key": 7, "vec_id": 7, "label": 3}]
    near = list(negatives.same_label(chunk, asked, [negatives.Anchor(x[0]), negatives.Anchor(x[1])], 4))
    assert near == [(0, 0, 3, 36), (0, 0, 2, 18), (0, 0, 1, 9), (0, 0, 4, -18)]
