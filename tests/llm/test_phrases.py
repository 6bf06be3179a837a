"""Phrase collocations against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from curvelake.llm import phrases
from curvelake.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, gram string, n int, f long, c long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows, longest):
    found = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(w)):
                for k in range(1, min(longest, len(w) - i) + 1):
                    found["und" if lang is None else lang][tuple(w[i:i + k])] += 1
    return found


def brute(rows, longest=4, min_count=30, top=2000):
    out = []
    for lang, c in counts(rows, longest).items():
        cand = {g: v for g, v in c.items() if len(g) > 1 and v >= min_count}
        covered = {g[i:i + m] for g, v in cand.items() for m in range(2, len(g)) for i in range(len(g) - m + 1)
                   if 100 * v >= 80 * cand[g[i:i + m]]}
        ranked = []
        for g, a in cand.items():
            if g not in covered:
                score, k = min((2_000_000 * a // (c[g[:k]] + c[g[k:]]), k) for k in range(1, len(g)))
                ranked.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        n = sum(v for g, v in c.items() if len(g) == 1)
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "g", 1, 2, 3) for i, (lang, t) in enumerate(rows)], SCHEMA).repartition(3)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def made(seed, n=60):
    """Few words, so that grams repeat; ties, separators and odd characters."""
    rng = random.Random(seed)
    words = ["A", "b", "c-d", "É", "日本", "x", "y", "\x00", "ÿ​", "the"]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n"]) for _ in range(rng.randint(0, 80)))
    return [(rng.choice(["en", "de", None, "und", ""]), text()) for _ in range(n)] + [("en", None), ("fr", ""), ("en", " \t. ,")]


@pytest.mark.parametrize("longest, least", [(4, 2), (4, 5), (3, 3), (5, 2)])
def test_made_texts(spark, longest, least):
    rows = made(longest * 10 + least)
    assert got(phrases.collocations(frame(spark, rows), longest, least)) == brute(rows, longest, least)


def test_top_and_repeated_rows(spark):
    rows = made(5) * 3
    assert got(phrases.collocations(frame(spark, rows), min_count=4, top=7)) == brute(rows, 4, 4, 7)


def test_counts_of_all_grams(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE_BYTES", 50)
    rows = made(9)
    want = {(lang, len(g), " ".join(g), v) for lang, c in counts(rows, 4).items() for g, v in c.items() if len(g) == 1 or v >= 3}
    assert {(r.lang, r.n, r.gram, r.f) for r in phrases.count_grams(frame(spark, rows), min_count=3).collect()} == want


def test_full_bitmap_changes_no_count(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(phrases, "frequent_hashes", lambda *a, **k: np.full(phrases.FILTER_BITS // 8, 255, np.uint8))
    rows = made(11)
    assert got(phrases.collocations(frame(spark, rows), min_count=3)) == brute(rows, 4, 3)


def test_long_text_and_paths(spark):
    passage = "one two three four five six seven eight nine ten"
    rows = [("en", " ".join(f"w{i % 997}" for i in range(200_000)) + "\n" + f"{passage}\n" * 40)]
    df = frame(spark, rows)
    assert got(phrases.collocations(df)) == brute(rows)
    paths = phrases.compact(phrases.count_grams(df)).where(f"path LIKE '%three four five%'").collect()
    assert [(r.path, r.f, r.edges) for r in paths] == [(passage, 40, 7)]


def test_empty(spark):
    assert got(phrases.collocations(frame(spark, []).where("false"))) == []


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("lang", "text").collect()]
    assert got(QUERIES["op11_phrases"](spark, path)) == brute(rows)
