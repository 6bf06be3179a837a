"""BPE encoding by tree concatenation, and decoding.

A text is cut where the pre-tokenizer cuts it in any context: before a space that stands
between two characters that are not white space.  Pieces of up to LEAF_CHARS go to the
tokenizers library as they are (where a text is only pieces, a worker keeps the ids of those it has
seen last, about CACHE_PIECES and as many from before; a piece of letters and symbols needs the
library's model only).  A longer piece is long unsplit text.  It is pre-tokenized by the library;
a pre-token above LEAF_BYTES is encoded as a tree:

* it is halved until each leaf has at most LEAF_BYTES, and the leaves, as rows of their own,
  are encoded in parallel by the library's model;
* neighbours are joined level by level.  Around a join the last ``w`` tokens of the left and
  the first ``w`` of the right side are decoded and encoded again.  If the new tokens agree
  with the left side in a token before the join and with the right side in one after it, the
  three are spliced at these tokens; else ``w`` doubles, up to both whole sides.

Why this is exact: a token sequence is the BPE encoding of its bytes if each two neighbours
are the encoding of theirs.  That holds inside both sides and inside the new window, and at a
shared token each pair lies in one of them.  It needs every token to be the encoding of its
own bytes, which ``Codec`` checks once for the vocabulary; where it does not hold, or the
tokenizer is not a byte-level BPE of the plain form, whole texts go to the library.

Defined results: a null text counts as empty (no ids, decoded to the empty string); rows that
repeat a doc_id are rows of their own; a null doc_id stays.  Extra columns are ignored by
``encode`` unless asked for.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import schema_of, stage, worker_cache

LEAF_CHARS = 4096
LEAF_BYTES = 4096
CACHE_PIECES = 250_000
CACHE_CHARS = 64
WINDOW = 16
STEP = 128                # rows encoded or decoded at once
#: before a space between two characters that are not white space
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: letters, then symbols: after a space the pre-tokenizer makes these one or two pre-tokens
_LETTERS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\[-`{}~]*)")


class Codec:
    """A tokenizer file with what the tree needs; one per Python worker (``codec``)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        added = spec.get("added_tokens", [])
        self.special = [t["content"] for t in added]
        self.plain = (model["type"] == "BPE" and spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                      and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                      and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                         "end_of_word_suffix", "byte_fallback", "ignore_merges"))
                      and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or " " in t["content"] for t in added))
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte-level alphabet
        rest = [b for b in range(256) if b not in shown]
        self.letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.now: dict[str, bytes | None] = {}
        self.before: dict[str, bytes | None] = {}
        self.decimal = [str(i) for i in range(self.tok.get_vocab_size())]
        self.string = {i: t for t, i in model["vocab"].items()}
        octet = {c: b for b, c in self.letter.items()}
        self.octets = {i: bytes(octet[c] for c in t) for i, t in self.string.items() if all(c in octet for c in t)}
        self.octets |= {t["id"]: t["content"].encode() for t in added}
        self._own: bool | None = None

    @property
    def stable(self) -> bool:
        """Whether every token that merges make is the encoding of itself."""
        if self._own is None:
            reach = set(self.string.values()) - set(self.special)
            self._own = all(len(self.model(t)) == 1 for t in reach)
        return self._own

    def model(self, string: str) -> list[int]:
        """The merges alone on a byte-level string, without pre-tokenizer."""
        return [t.id for t in self.tok.model.tokenize(string)]

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _direct(self, piece: str) -> bytes | None:
        """Ids of a space and ``piece``, if that is letters and then symbols."""
        m = _LETTERS.fullmatch(piece)
        if m is None:
            return None
        word, symbols = m.groups()
        ids = (self.now.get(word) or self.before.get(word)) if symbols else None
        if ids is None:
            string = word if word.isascii() else "".join([self.letter[b] for b in word.encode()])
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.tok.model.tokenize(self.letter[32] + string)])
            if symbols:
                self.now[word] = ids
        return ids + _bytes(self.model(symbols)) if symbols else ids

    def spaced(self, parts: list[str]) -> bytes | None:
        """Ids of the parts, each with a space before it; None if one is no piece (empty, long,
        or with white space at an end, where the pre-tokenizer may not cut)."""
        known = self.now
        hard = []
        for p in {p for p in parts if p not in known}:
            if p in self.before:
                known[p] = self.before[p]
            elif len(p) > LEAF_CHARS:
                return None
            elif not p or p[0].isspace() or p[-1].isspace():
                known[p] = None
            elif (ids := self._direct(p)) is not None:
                known[p] = ids
            else:
                hard.append(p)
        known.update(zip(hard, (_bytes(i) for i in self.library([" " + p for p in hard])), strict=True))
        out = [known[p] for p in parts]
        if len(known) > CACHE_PIECES:
            self.before, self.now = known, {}
        elif hard and max(map(len, hard)) > CACHE_CHARS:
            for p in hard:
                if len(p) > CACHE_CHARS:
                    del known[p]
        return None if None in out else b"".join(out)

    def pieces(self, pieces: list[str]) -> bytes:
        return b"".join([_bytes(i) for i in self.library(pieces)])

    def decode(self, ids: list[int]) -> bytes:
        """The decoded text in UTF-8, as the library's decode() with special tokens."""
        if self.plain:
            out = b"".join([self.octets.get(i, b"") for i in ids])
            try:
                out.decode()
                return out
            except UnicodeDecodeError:
                pass  # the library says how broken sequences are shown
        return self.tok.decode(ids, skip_special_tokens=False).encode()


def codec(path: str) -> Codec:
    kept = worker_cache("codecs")
    if path not in kept:
        kept[path] = Codec(path)
    return kept[path]


def cut(c: Codec, text: str) -> Iterator[str | list[str]]:
    """The text in order: a string is a piece for the library; a list has the leaves
    (byte-level strings, one or more) of one pre-token of a long piece."""
    if not c.plain:
        yield text
        return
    for piece in _CUT.split(text):
        if len(piece) <= LEAF_CHARS or any(s in piece for s in c.special) or not c.stable:
            yield piece
        else:
            for string, _ in c.tok.pre_tokenizer.pre_tokenize_str(piece):
                yield halves(string)


def halves(string: str) -> list[str]:
    """``string`` halved until no part is above LEAF_BYTES."""
    if len(string) <= LEAF_BYTES:
        return [string]
    mid = len(string) // 2
    return halves(string[:mid]) + halves(string[mid:])


def join(c: Codec, left: list[int], right: list[int]) -> list[int]:
    """The encoding of the text of ``left`` followed by that of ``right``."""
    w = WINDOW
    while True:
        a, b = max(0, len(left) - w), min(len(right), w)
        new = c.model("".join([c.string[i] for i in left[a:] + right[:b]]))
        if (a == 0 or new[0] == left[a]) and (b == len(right) or new[-1] == right[b - 1]):
            return left[:a] + new + right[b:]
        w *= 2


def concatenate(c: Codec, parts: list[list[int]]) -> list[int]:
    """Neighbours joined pairwise until one is left."""
    while len(parts) > 1:
        parts = [join(c, *parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def encode_text(c: Codec, text: str) -> np.ndarray:
    """Ids of a whole text, the tree included, in this process."""
    if c.plain:
        parts = text.split(" ")
        first = parts[0]
        if first and len(first) <= LEAF_CHARS and not first[-1].isspace() and (rest := c.spaced(parts[1:])) is not None:
            return np.frombuffer(c.pieces([first]) + rest, "<i4")
    out, pieces = [], []
    for s in cut(c, text):
        if isinstance(s, str):
            pieces.append(s)
        else:
            out += [c.pieces(pieces), np.array(concatenate(c, [c.model(x) for x in s]), "<u4").tobytes()]
            pieces = []
    return np.frombuffer(b"".join([*out, c.pieces(pieces)]), "<i4")


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in ids], dtype=np.int64))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, "<i4"), *ids])))


def encode(docs: DataFrame, tokenizer: str, keep: list[str] | None = None,
           text: str = "text", column: str = "ids") -> DataFrame:
    """The columns ``keep`` (default: doc_id) of every row and its ids as array<int>.

    Rows with a long run without space take the parallel path, in which their leaves are rows.
    """
    narrow = docs.select(*(keep or ["doc_id"]), F.col(text).alias(inner := "_bpe_text"))
    run = F.coalesce(F.col(inner).rlike(f"(?:^|\\x20)[^\\x20]{{{LEAF_CHARS + 1}}}")
                     & (F.length(inner) > LEAF_CHARS), F.lit(False))
    kept, n = schema_of(narrow.drop(inner)), len(narrow.columns) - 1

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = codec(tokenizer)
            for i in range(0, b.num_rows, STEP):
                some = b.slice(i, STEP)
                ids = [encode_text(c, t or "") for t in some.column(n).to_pylist()]
                yield pa.RecordBatch.from_arrays([*some.columns[:n], _lists(ids)], [*some.schema.names[:n], column])

    plain = narrow.where(~run).mapInArrow(whole, f"{kept}, `{column}` array<int>")
    return plain.unionByName(_encode_long(narrow.where(run), tokenizer, column))


def _encode_long(long: DataFrame, tokenizer: str, column: str) -> DataFrame:
    """The same for rows with long unsplit text: leaves are encoded and joined as rows."""
    rows = stage(long.withColumn("_row", F.monotonically_increasing_id()), "long")
    kept = rows.drop("_bpe_text")

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = codec(tokenizer)
            for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                pre, pieces = 0, []
                for s in [*cut(c, text), None]:
                    if isinstance(s, str):
                        pieces.append(s)
                    elif s is None or len(s) > 1:
                        yield _part(row, pre, [0], [None], [np.frombuffer(c.pieces(pieces), "<i4")])
                        pieces = []
                        for i in range(0, len(s or []), STEP):
                            some = s[i:i + STEP]
                            yield _part(row, pre + 1, range(i, i + len(some)), some, [np.empty(0, "<i4")] * len(some))
                        pre += 2
                    else:
                        yield _part(row, pre, [0], [None], [np.frombuffer(c.pieces(pieces) + _bytes(c.model(s[0])), "<i4")])
                        pieces, pre = [], pre + 1

    def leaf_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = codec(tokenizer)
            ids = [np.array(c.model(s), "<i4") if s is not None else np.array(old, "<i4")
                   for s, old in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], _lists(ids)], ["row", "pre", "leaf", "ids"])

    def pair(pdf):
        c, pdf = codec(tokenizer), pdf.sort_values("leaf")
        ids = concatenate(c, [list(x) for x in pdf["ids"]])
        return pdf.head(1)[["row", "pre"]].assign(leaf=pdf["leaf"].iloc[0] // 2, ids=[ids])

    def assemble(pdf):
        pdf = pdf.sort_values("pre")
        return pdf.head(1)[["row"]].assign(ids=[np.concatenate(pdf["ids"].to_list())])

    level = "row long, pre int, leaf int, ids array<int>"
    parts = stage(rows.select("_row", "_bpe_text").mapInArrow(leaves, "row long, pre int, leaf int, string string, ids array<int>"),
                  "leaves")
    done = stage(parts.repartition("row", "pre", "leaf").mapInArrow(leaf_ids, level), "encoded")
    while (done.agg(F.max("leaf")).first()[0] or 0) > 0:
        # an odd last part has no neighbour: it is a group of one and goes up as it is
        done = stage(done.groupBy("row", "pre", F.floor(F.col("leaf") / 2)).applyInPandas(pair, level), "joined")
    texts = done.groupBy("row").applyInPandas(assemble, "row long, ids array<int>")
    return kept.join(texts, kept["_row"] == texts["row"]).select(
        *[c for c in kept.columns if c != "_row"], F.col("ids").alias(column))


def _bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


def _part(row: int, pre: int, leaf, strings: list, ids: list[np.ndarray]) -> pa.RecordBatch:
    n = len(strings)
    return pa.RecordBatch.from_arrays(
        [pa.array([row] * n, pa.int64()), pa.array([pre] * n, pa.int32()), pa.array(list(leaf), pa.int32()),
         pa.array(strings, pa.string()), _lists(ids)], ["row", "pre", "leaf", "string", "ids"])


def _ints(column: pa.Array) -> Iterator[list[int]]:
    """The lists of a list<int> column, null as empty."""
    flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield flat[a:b].tolist()


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", column: str = "text") -> DataFrame:
    """All columns of ``encoded`` and the decoded text (special tokens kept)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = codec(tokenizer)
            for i in range(0, b.num_rows, STEP):
                some = b.slice(i, STEP)
                out = [c.decode(x).decode() for x in _ints(some.column(some.schema.get_field_index(ids)))]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(out, pa.string())],
                                                 [*some.schema.names, column])

    return encoded.mapInArrow(run, f"{schema_of(encoded)}, `{column}` string")


def digests(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of (doc_id, ids array<int>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = codec(tokenizer)
            n, sums, texts = [], [], []
            for ids in _ints(b.column(1)):
                n.append(len(ids))
                sums.append(hashlib.sha256(",".join([c.decimal[i] for i in ids]).encode()).hexdigest())
                texts.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(sums, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
