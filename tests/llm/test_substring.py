"""Substring dedup against brute force."""

import hashlib
import random

import numpy as np

from curvelake.llm import substring
from curvelake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lo string, gram string"


def brute(docs, size=50):
    first = {}
    for d, t in docs:
        words = (t or "").encode().split()
        for i in range(len(words) - size + 1):
            if d is not None:
                key = b" ".join(words[i:i + size])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in docs:
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            if d is not None and first[b" ".join(words[i:i + size])] < d:
                gone[i:i + size] = [True] * size
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((d, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs)
    assert sum(r[2] for r in want) > 0
    assert result(QUERIES["op7_substring"](spark, SF)) == want


def made(seed=0):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "cc", "é", "日本"]) + str(rng.randrange(40))
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 75, 130, 400)]
    docs = []
    for d in range(120):
        parts = [[word() for _ in range(rng.randrange(0, 120))]]
        for _ in range(rng.randrange(0, 3)):
            p = list(rng.choice(passages))
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = "edit"
            parts += [p, [word() for _ in range(rng.randrange(0, 30))]]
        docs.append((rng.randrange(1000) if d % 7 else 1000 + d, rng.choice([" ", "\n", "\t  "]).join(w for p in parts for w in p)))
    same = " ".join(["x"] * 200)
    docs += [(2000, same), (2001, same), (2001, same), (2002, " ".join(["x"] * 60)), (None, same), (None, None),
             (3000, None), (3001, ""), (3002, " \n "), docs[3], docs[3], (docs[4][0], docs[5][1])]
    return docs


def test_made_rows(spark):
    for seed in (1, 2):
        docs = made(seed)
        df = spark.createDataFrame([(*r, "x", "y") for r in docs], SCHEMA).repartition(5)
        assert result(substring.remove_repeats(df)) == brute(docs)


def test_other_size(spark):
    docs = made(3)
    df = spark.createDataFrame([(*r, "x", "y") for r in docs], SCHEMA)
    assert result(substring.remove_repeats(df, 9)) == brute(docs, 9)


def test_empty(spark):
    assert substring.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_text_in_slices():
    text = b"  ".join([b"word", b"x" * 5000, b"tail"] * 700)
    got, old = substring.word_hashes(text), substring.SLICE_BYTES
    try:
        substring.SLICE_BYTES = 1000
        assert np.array_equal(substring.word_hashes(text), got)
    finally:
        substring.SLICE_BYTES = old
    assert len(got) == 2100 and len(set(got.tolist())) == 3


def test_levels(spark):
    words = [f"w{i}" for i in range(450)]
    docs = [(1, " ".join(words)), (2, "z " + " ".join(words[:210])), (3, " ".join(words[300:360]))]
    got = {r.length: (r.documents, r.windows) for r in substring.repeat_levels(
        spark.createDataFrame([(*d, "", "") for d in docs], SCHEMA)).collect()}
    assert got == {50: (3, 2 * 161 + 2 * 11), 100: (2, 2 * 111), 200: (2, 2 * 11)}
