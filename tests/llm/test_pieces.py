"""SentencePiece encoding against the library."""

import hashlib
import random

import pytest
import sentencepiece

from curvelake.llm import pieces
from curvelake.llm.queries import QUERIES, tokenizer_file

PATH = tokenizer_file("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids string, _text string, decoded string"


@pytest.fixture(scope="module")
def model():
    return pieces.model(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


ODD = ["", " ", "  ", "a", " a", "a ", "▁", "▁▁▁ ▁", "\n", "\n\n a\n", "ﬁ Ａ\x00b", "aaaa" * 50, " " * 77, " " * 16 + "x" + " " * 5,
       "日本語テキスト", "🙂🙂x🙂", "\t\t", "<s> </s> <unk> <0x0A>", "é" * 31 + "é", "  \n  \n", "a,b.c;d:e!f?g", "x" * 5000, "the," * 3000]


def test_words_of_the_alphabet(model, library):
    rng = random.Random(1)
    some = [" ", "▁", "a", "e", "t", "h", "in", "th", "\n", "é", "日", "=", "-", "0", "1", "  ", "\t", "🙂", ",", "."]
    texts = ODD + ["".join(rng.choices(some, k=rng.randint(1, 60))) for _ in range(4000)]
    texts += ["".join(rng.choices(list(model.id), k=rng.randint(1, 8))) for _ in range(4000)]
    assert model.plain
    assert [model.encode(t).tolist() for t in texts] == library.encode(texts)


def test_follows_is_merging(model):
    rng = random.Random(2)
    ids = sorted(model.halves)
    for a, b in ((rng.choice(ids), rng.choice(ids)) for _ in range(20_000)):
        both = [model.piece[a], model.piece[b]]
        assert model.follows(a, b) == (model.merge("".join(both)) == both)


def test_cache_turns_over(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 20)
    monkeypatch.setattr(pieces, "CACHE_PAIRS", 10)
    rng = random.Random(3)
    m, texts = pieces.Model(PATH), [" ".join(str(rng.randint(0, 99)) for _ in range(40)) for _ in range(50)]
    assert [m.encode(t).tolist() for t in texts] == library.encode(texts)


def test_other_models_go_to_the_library(monkeypatch, library):
    m = pieces.Model(PATH)
    m.plain = False
    assert [m.encode(t).tolist() for t in ODD] == library.encode(ODD)


def test_rows(spark, library):
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(ODD)] + [(0, ODD[4], "x", "y", "z"), (None, "null id", "", "", ""), (99, None, "", "", "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    encoded = pieces.encode(df, PATH, keep=["doc_id", "_text"])
    found = sorted(((r.doc_id is None, r.doc_id, r.ids, r.text) for r in pieces.decode(encoded, PATH).collect()), key=repr)
    want = sorted(((r[0] is None, r[0], i := library.encode(r[1] or ""), library.decode(i)) for r in rows), key=repr)
    assert found == want
    assert pieces.digests(pieces.encode(df.where("false"), PATH), PATH).collect() == []


def test_whole_table(spark, library):
    path = "/root/testdata/sf0.01"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    ids = library.encode([d.text or "" for d in docs])
    want = {(d.doc_id, len(i), sha(",".join(map(str, i))), sha(library.decode(i))) for d, i in zip(docs, ids)}
    assert {tuple(r) for r in QUERIES["op12_pieces"](spark, path).collect()} == want
