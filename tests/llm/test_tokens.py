"""Token files and BPE against the tokenizers library on whole texts."""

import hashlib
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from curvelake.llm import bpe, token_files
from curvelake.llm.queries import QUERIES, tokenizer_file

SF = "/root/testdata/sf0.01"
WORDS, BYTES = tokenizer_file("word_bpe_49k.json"), tokenizer_file("byte_bpe_50k.json")
ODD = ["", None, " ", "\n\n \t x", "a  b", "it's  we'll 'S <|endoftext|> x<|endoftext|>y <|startoftext|>", "é é ́x ǅ İ ſ",
       "　日本語 テキスト x\x1cy\x85z", "a b 12345 ٣٤", "x\r\n\r\n  y   ", "\U0001f600\U0001f600 �", "A" * 9001]
SCHEMA = "doc_id long, text string, lang string, ids string, _row string, row int"


def rows(texts):
    return [(i, t, "en", "x", "y", 1) for i, t in enumerate(texts)]


def library(path, texts):
    tok = Tokenizer.from_file(path)
    return [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_files_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want, start = [], 0
    for d, ids in zip(docs, library(WORDS, [d.text for d in docs])):
        ids = [*ids, 2]
        want.append((d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = QUERIES["op1_token_files"](spark, SF).collect()
    assert sorted(tuple(r)[:4] for r in got) == want


def test_token_files_odd_rows(spark):
    texts = [*ODD, "same", "same"]
    data = [*rows(texts), (5, "again", "", "", "", 0), (None, "no id", "", "", "", 0)]
    got = token_files.round_trip(spark.createDataFrame(data, SCHEMA).repartition(3), WORDS).collect()
    got = sorted(map(tuple, got), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted([r[0] for r in data], key=lambda d: (d is not None, d or 0))
    ids = library(WORDS, [r[1] for r in data])
    sums = sorted(zlib.crc32(np.array([*i, 2], "<u4").tobytes()) for i in ids)
    assert sorted(r[3] for r in got) == sums
    assert [r[1] for r in got] == list(np.cumsum([0] + [r[2] for r in got][:-1]))


def test_token_files_empty(spark):
    assert token_files.round_trip(spark.createDataFrame([], SCHEMA), WORDS).count() == 0


def test_other_tokenizer_uses_whole_texts(spark):
    texts = ["a  b\n\nc", " x"]
    got = token_files.round_trip(spark.createDataFrame(rows(texts), SCHEMA), BYTES).orderBy("doc_id").collect()
    assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array([*i, 2], "<u4").tobytes()) for i in library(BYTES, texts)]


def digest(texts):
    tok = Tokenizer.from_file(BYTES)
    out = []
    for ids in library(BYTES, texts):
        text = tok.decode(ids, skip_special_tokens=False)
        out.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_bpe_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: w for d, w in zip(docs, digest([d.text for d in docs]))}
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op5_bpe"](spark, SF).collect()} == want


def test_bpe_odd_rows(spark):
    rng = np.random.default_rng(1)
    long = ["x" * 30_000, "".join(rng.choice(list("abcdefgh"), 20_001)), " " * 9000 + "y", "".join(rng.choice(list("aé'ls日 \n"), 30_000)),
            "-" * 5000 + "z <|endoftext|>" + "ab" * 6000, "word " + "".join(rng.choice(list("theaning"), 9_999)) + " tail",
            "".join(rng.choice(list("ththeingé1"), 50_000)), "\n\n" + "q" * 4097 + "  r", "日本語" * 3000]
    texts = [*ODD, *long, "same", "same"]
    docs = spark.createDataFrame([*rows(texts), (None, "q", "", "", "", 0)], SCHEMA).repartition(3)
    got = bpe.digests(bpe.encode(docs, BYTES), BYTES).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got if r.doc_id is not None} == dict(enumerate(digest(texts)))
    assert [tuple(r)[1:] for r in got if r.doc_id is None] == digest(["q"])


def test_bpe_empty(spark):
    assert bpe.digests(bpe.encode(spark.createDataFrame([], SCHEMA), BYTES), BYTES).count() == 0


@pytest.mark.parametrize("letters", ["ab", "theaning", "0123456789", "日本語x", " "])
def test_tree_equals_library(letters):
    c = bpe.codec(BYTES)
    rng = np.random.default_rng(len(letters))
    for n in (4097, 9000, 40_000):
        text = "".join(rng.choice(list(letters), n))
        assert bpe.encode_text(c, text).tolist() == library(BYTES, [text])[0]


def test_decode_equals_library():
    c, tok = bpe.codec(BYTES), Tokenizer.from_file(BYTES)
    rng = np.random.default_rng(7)
    for n in (0, 1, 2, 5, 50, 400):
        for _ in range(60):
            ids = rng.integers(0, 50257, n).tolist()  # broken UTF-8 and special tokens among them
            assert c.decode(ids).decode() == tok.decode(ids, skip_special_tokens=False)


def test_pieces_equal_library():
    """Every way that spaces, letters and symbols can meet."""
    rng = np.random.default_rng(8)
    bits = ["a", "Word", "éa", "ß", "'s", "'", ",", ".\n", "\n", " ", "  ", "\t", "\u00a0", "\u3000", "x1", "12", "--", "(a)", "日", "<|endoftext|>", "!?", "ÿ×", "\x1c", "\x85"]
    texts = ["".join(rng.choice(bits, rng.integers(1, 14))) for _ in range(4000)]
    c = bpe.codec(BYTES)
    assert [bpe.encode_text(c, t).tolist() for t in texts] == library(BYTES, texts)
    assert [bpe.encode_text(c, t).tolist() for t in texts] == library(BYTES, texts)  # from the cache


def test_words_equal_library():
    rng = np.random.default_rng(9)
    bits = ["a", "Word", "Éa", "ß", "'s", "'", ",", ".\n", "\n", " ", "\t", "\u00a0", "x1", "12", "--", "(a)", "日", "<|endoftext|>", "!?", "ÿ×", "e\u0301", "İ", "Σ", "ſ"]
    texts = ["".join(rng.choice(bits, rng.integers(1, 14))) for _ in range(4000)]
    run = token_files.encoder(WORDS)
    assert [np.frombuffer(x, "<u4").tolist() for x in run(texts)] == library(WORDS, texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in run(texts)] == library(WORDS, texts)
