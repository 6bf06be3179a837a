"""Token ids as flat binary files with 64-bit document offsets.

``write_tokens`` range-partitions documents by doc_id, tokenizes each partition and writes
one segment per partition: ``tokens`` (flat unsigned integers, 16-bit where the vocabulary
allows, else 32-bit, little-endian), ``ids`` (doc_id as signed 64-bit) and ``lengths``
(unsigned 32-bit would bound a document, so signed 64-bit).  A second job turns lengths into
``offsets``: the segment's base, which is a prefix sum over the segments' totals, plus the
running sum in the segment (n + 1 numbers, the last being the next segment's base).
``read_tokens`` maps the files of a segment and yields document by document.

Files go to the shared folder through ``pyarrow.fs`` (file, hdfs, s3, ...).  A task writes
under a name of its own attempt and then moves the files to their final names, so a repeated
task replaces them by equal ones.

Words between ASCII white space do not influence each other under the tokenizers that
``word_safe`` accepts; for those every worker keeps the ids of the words it has seen last
(about CACHE_WORDS, and as many from before).  Other tokenizers encode whole texts.

Defined results: a null text counts as empty and holds the end id only; rows are ordered by
(doc_id, hash of text), null doc_ids first (stored as -2**63); rows that repeat a doc_id are
documents of their own.  Extra columns are ignored.  An empty table gives no documents.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvelake.llm.common import run_folder, worker_cache

END_ID = 2
NULL_ID = -(1 << 63)
CACHE_WORDS = 750_000
#: Word-wise encoding is the same as encoding whole texts for these parts of a tokenizer.
_SAFE_NORMALIZERS = {"NFC", "Lowercase", "Replace"}


def word_safe(spec: dict) -> bool:
    """Whether ASCII white space always separates and is then dropped: the normalizer works on
    characters, and the first pre-tokenizer keeps only matches of a pattern without spaces."""
    norm = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    parts = norm.get("normalizers", [norm])
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    return (all(p["type"] in _SAFE_NORMALIZERS for p in parts)
            and all(p["pattern"] == {"Regex": "\\s+"} and p["content"] == " " for p in parts if p["type"] == "Replace")
            and first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))
            and "[^\\s" in first["pattern"].get("Regex", "") and " " not in first["pattern"]["Regex"]
            and not any(set(t["content"]) & set(" \t\n\r\x0b\x0c") or t["lstrip"] or t["rstrip"] or t["single_word"]
                        for t in spec.get("added_tokens", [])))


def encoder(path: str, dtype: str = "<u4") -> Callable[[list[str]], list[bytes]]:
    """texts -> their ids as ``dtype``, by the tokenizers library without special tokens added; a worker
    keeps it."""
    kept = worker_cache("encoders")
    if (path, dtype) not in kept:
        kept[path, dtype] = _encoder(path, dtype)
    return kept[path, dtype]


def _encoder(path: str, dtype: str) -> Callable[[list[str]], list[bytes]]:
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)

    def library(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype).tobytes() for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    if not word_safe(spec):
        return library
    direct = _direct(tok, spec, np.dtype(dtype).itemsize)

    def run(texts: list[str]) -> list[bytes]:
        nonlocal known
        out = [b"".join(map(known.__getitem__, t.encode().split())) for t in texts]
        if len(known) > CACHE_WORDS:  # what was not seen since the last time goes
            known.before = {}
            known = _Words(known)
        return out

    class _Words(dict):
        """Ids of words, found when first asked for; ``before`` are those of the time before."""

        def __init__(self, before: dict | None = None):
            self.before = before or {}

        def __missing__(self, word: bytes) -> bytes:
            ids = self.before.get(word)
            if ids is None:
                ids = direct(word, self, self.before)
            if ids is None:
                ids = library([word.decode()])[0]
            self[word] = ids
            return ids

    known = _Words()
    return run


#: The pattern for which ``_direct`` knows what a word of letters, then symbols, is split into.
_PLAIN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\[-`{}~]*)")


def _direct(tok, spec: dict, size: int) -> Callable[[bytes, dict, dict], bytes | None]:
    """Ids (of ``size`` bytes) of a word of Latin letters with symbols after them, by the tokenizer's model alone,
    each part once (``known`` and ``before`` are looked up, ``known`` is added to); None for any
    other word, or if the tokenizer isn't of the kind this holds for."""
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    norm = (spec.get("normalizer") or {}).get("normalizers") or []
    if not (spec["model"]["type"] == "BPE" and pre[0].get("pattern") == {"Regex": _PLAIN_SPLIT} and len(pre) == 2
            and pre[1].get("type") == "ByteLevel" and not pre[1].get("use_regex") and not pre[1].get("add_prefix_space")
            and [n["type"] for n in norm] == ["NFC", "Replace", "Lowercase"]):
        return lambda word, known, before: None
    # byte-level alphabet: printable characters stand for themselves, others come after 255
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    octets = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    tokenize, match = tok.model.tokenize, _LETTERS.fullmatch

    def run(word: bytes, known: dict, before: dict) -> bytes | None:
        m = match(word.decode())
        if m is None:
            return None
        out = []
        for part in m.groups():
            if part:
                part = part.lower()
                key = part.encode()
                ids = known.get(key) or before.get(key)
                if ids is None:
                    string = part if len(key) == len(part) else "".join([octets[b] for b in key])
                    ids = known[key] = b"".join([t.id.to_bytes(size, "little") for t in tokenize(string)])
                out.append(ids)
        return out[0] if len(out) == 1 else b"".join(out)

    return run


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _put(store, path: str, data) -> None:
    with store.open_output_stream(path) as f:
        f.write(data)


def _get(store, path: str, dtype: str) -> np.ndarray:
    """The file as an array: mapped into memory where it is local, else read."""
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype)


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` (doc_id, text); return the manifest: segment, base, n_docs, n_tokens."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        top = max(json.load(f)["model"]["vocab"].values(), default=0)
    dtype = "<u2" if max(top, end_id) < 1 << 16 else "<u4"
    ordered = (docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
               .withColumn("_tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        segment, mine = task.partitionId(), f".{task.taskAttemptId()}"
        store, root = _store(folder)
        encode, n_docs, n_tokens = None, 0, 0
        names = [f"{root}/{kind}-{segment:07d}" for kind in ("tokens", "ids", "lengths")]
        store.create_dir(root, recursive=True)
        outs = [store.open_output_stream(n + mine) for n in names]
        end = np.array([end_id], dtype).tobytes()
        for b in batches:
            encode = encode or encoder(tokenizer, dtype)
            texts = b.column(1).to_pylist()
            ids = encode(texts)
            outs[0].write(b"".join([x for one in ids for x in (one, end)]))
            lengths = [len(one) // len(end) + 1 for one in ids]
            outs[1].write(np.array([NULL_ID if d is None else d for d in b.column(0).to_pylist()], "<i8").tobytes())
            outs[2].write(np.array(lengths, "<i8").tobytes())
            n_docs, n_tokens = n_docs + len(texts), n_tokens + sum(lengths)
        for out, name in zip(outs, names, strict=True):
            out.close()
            if n_docs:
                store.move(name + mine, name)
            else:
                store.delete_file(name + mine)
        if n_docs:
            yield pa.RecordBatch.from_pydict({"segment": [segment], "n_docs": [n_docs], "n_tokens": [n_tokens]})

    parts = f"{folder}/segments"
    ordered.select("doc_id", "text").mapInArrow(run, "segment long, n_docs long, n_tokens long").write.parquet(parts)
    # one row per segment: its base is the sum of all segments before it
    totals = spark.read.schema("segment long, n_docs long, n_tokens long").parquet(parts)
    base = F.sum("n_tokens").over(Window.orderBy("segment")) - F.col("n_tokens")

    def offsets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        for pdf in batches:
            for r in pdf.itertuples():
                lengths = _get(store, f"{root}/lengths-{r.segment:07d}", "<i8")
                ends = np.concatenate(([0], np.cumsum(lengths))).astype("<i8") + r.base
                name = f"{root}/offsets-{r.segment:07d}"
                _put(store, f"{name}.{TaskContext.get().taskAttemptId()}", ends.tobytes())
                store.move(f"{name}.{TaskContext.get().taskAttemptId()}", name)
            yield pdf.assign(dtype=dtype)[["segment", "base", "n_docs", "n_tokens", "dtype"]]

    manifest = f"{folder}/manifest"
    (_one_each(totals.withColumn("base", base))
     .mapInPandas(offsets, "segment long, base long, n_docs long, n_tokens long, dtype string").write.parquet(manifest))
    return _manifest(spark, folder)


def _one_each(segments: DataFrame) -> DataFrame:
    """About one segment in each partition."""
    return segments.repartitionByRange(max(1, segments.count()), "segment")


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    return (spark.read.schema("segment long, base long, n_docs long, n_tokens long, dtype string")
            .parquet(f"{folder}/manifest"))


def read_segment(store, root: str, segment: int, dtype: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start in the whole corpus, ids) of the documents of a segment, in order."""
    offsets = _get(store, f"{root}/offsets-{segment:07d}", "<i8")
    tokens, ids = _get(store, f"{root}/tokens-{segment:07d}", dtype), _get(store, f"{root}/ids-{segment:07d}", "<i8")
    for i, d in enumerate(ids.tolist()):
        a, b = int(offsets[i]), int(offsets[i + 1])
        yield (None if d == NULL_ID else d), a, tokens[a - int(offsets[0]):b - int(offsets[0])]


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers)."""
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for b in batches:
            for r in b.to_pylist():
                rows = [(d, a, len(t), zlib.crc32(t.astype("<u4").tobytes()))
                        for d, a, t in read_segment(store, root, r["segment"], r["dtype"])]
                for i in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*rows[i:i + 10_000], strict=True)], names)

    return _one_each(_manifest(spark, folder)).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` to a fresh shared folder and read the files back."""
    folder = run_folder(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, folder, end_id)
    return read_tokens(docs.sparkSession, folder)
