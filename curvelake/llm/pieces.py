"""SentencePiece (BPE) encoding by a table of each prefix's last token, and decoding.

The encoding of a text is read off a table that holds, for every prefix of it, the last token of that
prefix's encoding:

* an automaton over the vocabulary finds all tokens that end at a place;
* exactly one of them, ``t``, follows the last token of the prefix before it so that merging their two
  strings from characters gives just these two tokens (``Model.follows``).  It is the last token there;
* the ids are recovered backwards from the table's end, each token saying where the one before ends.

Why this is exact: merges go by score, then from the left.  In a row of tokens the first merge that
crosses a border between two of them would be made in the string of these two alone as well, so a
row is the encoding of its text if each two neighbours are the encoding of theirs, and the other
way round.  Hence the encoding of a prefix is that of a shorter prefix and one token more, and as
encodings are unique, so is the token.

``follows`` does not merge anything: it walks back through the merges that made the two tokens, from
the last to the first, and looks whether the two pieces at the border could have merged before one of
them was used up.  Tokens made by merges that are out of score order are merged literally.

A text is normalized by the library.  No token goes on over a space after another character (or to a mark
like a comma), so words are encoded one by one, and a worker keeps the ids of those seen last (about CACHE_WORDS and as many
from before).  A character that no token has stands alone and becomes its bytes.  Models of another
kind (unigram, no byte tokens, user-defined or unused tokens) go to the library as whole texts.

Defined results: a null text counts as empty (no ids, decoded to the empty string); texts and words of
any length are encoded whole, in time linear in their length; rows that repeat a doc_id are rows of
their own; a null doc_id stays.  Extra columns are ignored by ``encode`` unless asked for.  An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import free_name, schema_of, worker_cache

CACHE_WORDS = 500_000
CACHE_CHARS = 64
CACHE_PAIRS = 500_000
STEP = 128                # rows encoded or decoded at once
SPACE = "▁"
#: letters end before one of these, if no token goes on from a letter to it
_MARKS, _LETTER = ".,;:!?)\"]}", "[A-Za-zÀ-ÖØ-öø-ÿ]"
_NEVER = float("inf")


class _Words(dict):
    """Ids of words, found when first asked for; ``before`` are those of the time before."""

    def __init__(self, model: Model, before: dict | None = None):
        self.model, self.before = model, before or {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word) or self.model.word(word).tobytes()
        if len(word) <= CACHE_CHARS:
            self[word] = ids
        return ids


class _Followers(dict):
    """Whether tokens follow one token, found when first asked for."""

    def __init__(self, model: Model, token: int):
        self.model, self.token = model, token

    def __missing__(self, token: int) -> bool:
        self[token] = fits = self.model.follows(self.token, token)
        self.model.pairs += 1
        return fits


class Model:
    """A model file with what the table needs; one per Python worker (``model``)."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.decimal = [str(i) for i in range(n)]
        kind = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.piece = {i: sp.id_to_piece(i) for i in range(n) if not kind[i]}
        self.id = {p: i for i, p in self.piece.items()}
        self.size = {i: len(p) for i, p in self.piece.items()}
        # equal scores share a rank; single characters are there before any merge
        at = {s: k for k, s in enumerate(sorted({-sp.get_score(i) for i in self.piece}))}
        self.rank = {i: at[-sp.get_score(i)] if len(p) > 1 else -1 for i, p in self.piece.items()}
        self.now = _Words(self)
        self.followers: dict[int, _Followers] = {}
        self.pairs = 0
        octet = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.octet = [octet.get(b, -1) for b in range(256)]
        self.plain = (len(octet) == 256 and not any(sp.is_unused(i) for i in range(n)) and all(
            len(p) == 1 or SPACE not in p.lstrip(SPACE) and "\n" not in p and all(c in self.id for c in p) for p in self.id))
        self.plain = self.plain and self._merges_only() and "\n" not in self.id
        if self.plain:
            self._trees()
            self.words = re.compile(self._words())

    def _words(self) -> str:
        """A pattern that cuts a normalized text where no token can go on: before spaces and line ends
        after another character, and between letters and those marks that follow a letter in no token."""
        marks = set(_MARKS) - {b for p in self.id for a, b in zip(p, p[1:], strict=False) if re.match(_LETTER, a)}
        cut = f"{SPACE}*{_LETTER}+(?=[{re.escape(''.join(sorted(marks)))}])|" if marks else ""
        return f"{cut}{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"

    def _merges_only(self) -> bool:
        """Whether the library encodes as a BPE by these scores (a unigram model would not), seen on the tokens."""
        some = [p for p in self.id if SPACE not in p][:: max(1, len(self.id) // 500)]
        text = "".join(some)
        return [t for t in self.sp.encode(SPACE + text)] == [t for t in self._ids(self.merge(self._prefixed(text)))]

    def _prefixed(self, text: str) -> str:
        return self.sp.normalize(SPACE + text)

    def _ids(self, parts: list[str]) -> list[int]:
        return [i for p in parts for i in ([self.id[p]] if p in self.id else [self.octet[b] for b in p.encode()])]

    def merge(self, text: str) -> list[str]:
        """Merges from characters, literally: the best score first, then the leftmost."""
        parts = list(text)
        while True:
            best, where = _NEVER, -1
            for k in range(len(parts) - 1):
                i = self.id.get(parts[k] + parts[k + 1])
                if i is not None and self.rank[i] < best:
                    best, where = self.rank[i], k
            if where < 0:
                return parts
            parts[where:where + 2] = [parts[where] + parts[where + 1]]

    def _trees(self) -> None:
        """The two tokens that make each token, and the automaton of all tokens that merges reach."""
        import ahocorasick

        self.halves: dict[int, tuple[int, int]] = {}
        self.ordered: set[int] = {i for i, p in self.piece.items() if len(p) == 1}
        self.tokens = ahocorasick.Automaton()
        for p, i in sorted(self.id.items(), key=lambda e: len(e[0])):
            if len(p) > 1:
                parts = self._last_two(p)
                if parts is None:
                    continue  # merges of its characters never end in this token
                left, right = self.halves[i] = parts
                if {left, right} <= self.ordered and self.rank[left] < self.rank[i] > self.rank[right]:
                    self.ordered.add(i)
            self.tokens.add_word(p, (i, len(p)))
        self.tokens.make_automaton()

    def _last_two(self, piece: str) -> tuple[int, int] | None:
        parts = list(piece)
        while len(parts) > 2:
            ranks = [self.rank.get(self.id.get(a + b, -1), _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            k = ranks.index(min(ranks))
            if ranks[k] == _NEVER:
                return None
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return self.id[parts[0]], self.id[parts[1]]

    def follows(self, a: int, b: int) -> bool:
        """Whether merging the strings of ``a`` and ``b`` together gives ``a`` and ``b`` again."""
        piece, rank = self.piece, self.rank
        if a not in self.ordered or b not in self.ordered:
            return self.merge(piece[a] + piece[b]) == [piece[a], piece[b]]
        used_a = used_b = _NEVER     # the rank of the merge that uses up the piece at the border
        while True:
            made = self.id.get(piece[a] + piece[b])
            # on a tie the merge further to the left is made first
            if made is not None and rank[made] < used_a and rank[made] <= used_b:
                return False
            if rank[a] > rank[b]:
                used_a, a = rank[a], self.halves[a][1]
            elif rank[b] >= 0:
                used_b, b = rank[b], self.halves[b][0]
            else:
                return True

    def word(self, word: str) -> array:
        """Ids of a normalized word, through the table."""
        n, followers = len(word), self.followers
        if self.pairs > CACHE_PAIRS:
            followers.clear()
            self.pairs = 0
        last = [-1] * (n + 1) if n <= CACHE_CHARS else array("i", [-1]) * (n + 1)
        for end, (token, size) in self.tokens.iter(word):
            end += 1
            if last[end] < 0:
                before = last[end - size]
                # -1: the text's begin, or a character that no token has
                if before < 0:
                    last[end] = token
                else:
                    if before not in followers:
                        followers[before] = _Followers(self, before)
                    if followers[before][token]:
                        last[end] = token
        out, at = array("i"), n
        while at:
            token = last[at]
            if token < 0:
                out.extend([self.octet[b] for b in reversed(word[at - 1].encode())])
                at -= 1
            else:
                out.append(token)
                at -= self.size[token]
        out.reverse()
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if not self.plain:
            return np.array(self.sp.encode(text), "<i4")
        words = self.words.findall(self.sp.normalize(text)) if text else []
        out = np.frombuffer(b"".join(map(self.now.__getitem__, words)), "<i4")
        if len(self.now) > CACHE_WORDS:  # what was not seen since the last time goes
            self.now.before = {}
            self.now = _Words(self, self.now)
        return out


def model(path: str) -> Model:
    kept = worker_cache("pieces")
    if path not in kept:
        kept[path] = Model(path)
    return kept[path]


def encode(docs: DataFrame, path: str, keep: list[str] | None = None, text: str = "text", column: str = "ids") -> DataFrame:
    """The columns ``keep`` (default: doc_id) of every row and its ids as array<int>."""
    narrow = docs.select(*(keep or ["doc_id"]), F.coalesce(text, F.lit("")).alias(inner := free_name(docs, "_text")))
    n = len(narrow.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = model(path)
            for i in range(0, b.num_rows, STEP):
                some = b.slice(i, STEP)
                ids = [m.encode(t) for t in some.column(n).to_pylist()]
                ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                flat = np.concatenate([np.empty(0, "<i4"), *ids])
                yield pa.RecordBatch.from_arrays([*some.columns[:n], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                                 [*some.schema.names[:n], column])

    return narrow.mapInArrow(run, f"{schema_of(narrow.drop(inner))}, `{column}` array<int>")


def _lists(column: pa.Array) -> Iterator[list[int]]:
    """The lists of a list<int> column, null as empty."""
    flat, ends = column.values.to_numpy(), column.offsets.to_numpy().tolist()
    for a, b in zip(ends, ends[1:], strict=False):
        yield flat[a:b].tolist()


def decode(encoded: DataFrame, path: str, ids: str = "ids", column: str = "text") -> DataFrame:
    """All columns of ``encoded`` and the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = model(path)
            for i in range(0, b.num_rows, STEP):
                some = b.slice(i, STEP)
                out = [m.sp.decode(x) if x else "" for x in _lists(some.column(some.schema.get_field_index(ids)))]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(out, pa.string())], [*some.schema.names, column])

    return encoded.mapInArrow(run, f"{schema_of(encoded)}, `{column}` string")


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of (doc_id, ids array<int>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = model(path)
            n, sums, texts = [], [], []
            for ids in _lists(b.column(1)):
                n.append(len(ids))
                sums.append(hashlib.sha256(",".join([m.decimal[i] for i in ids]).encode()).hexdigest())
                texts.append(hashlib.sha256((m.sp.decode(ids) if ids else "").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(sums, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
