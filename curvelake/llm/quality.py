"""Quality rules with cross-document line frequency.

Per document: word and symbol counts, lines that repeat an earlier one, and words in 5-word
windows that occur twice or more.  Across documents: lines are normalised (A-Z lower-cased,
digits made 0, white space collapsed), hashed, and counted by the distinct documents of their
host (``source``) that have them.  Lines above the host's limit are removed; a document with
too few words left is depleted and rejected; ``judge`` only counts the words of removed lines,
``keep_good`` gives the texts without them.

Copies of one page are not evidence of boilerplate, so lines are counted twice.  First by
distinct documents (texts); lines above the limit are common.  Then, for common lines, by what is
a document's own: documents count once if their lines that are not common are the same lines.  A
page with a line of its own thus counts however many lines it shares.  A document whose lines are
all common (a copy, but for digits) has nothing of its own to tell it from others; such documents
count once for a line if the smallest hash among their other lines is the same.  Lines above the
limit in both counts are removed.

Defined results: a null text counts as empty; a null host is a host of its own; rows that
repeat a doc_id are judged each; a document without words fails the base rule.  Extra columns
are ignored by ``judge`` and kept by ``keep_good``.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import free_name, stage

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
_NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
ALONE = -1  # surroundings of a line without other lines


@dataclass(frozen=True)
class Rules:
    """A line is boilerplate when it is in more than ``min_documents`` and more than
    ``max_share`` of its host's distinct documents.  A document is depleted when less than
    ``min_left`` of its words, and fewer than ``enough_words``, are left."""

    min_words: int = 10
    max_repeat_percent: int = 20
    min_documents: int = 20
    max_share: float = 0.02
    min_left: float = 0.3
    enough_words: int = 50


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words covered by ``size``-word windows that occur twice or more in ``words``."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
    bits = max(1, len(number).bit_length())
    key, done = ids[:n].copy(), 1
    held = bits  # bits that key takes
    while done < size:
        if held + bits > 64:  # rank what there is, so that it stays exact
            _, inverse = np.unique(key, return_inverse=True)
            key = inverse.astype(np.uint64)
            held = max(1, int(n).bit_length())
        key = (key << np.uint64(bits)) | ids[done:done + n]
        held, done = held + bits, done + 1
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[inverse] >= 2)
    if not len(at):
        return 0
    steps = np.zeros(len(words) + 1, np.int64)
    steps[at] += 1
    np.subtract.at(steps, at + size, 1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def line_hash(line: bytes) -> int:
    """The first 63 bits of the line's MD5."""
    return int.from_bytes(hashlib.md5(line, usedforsecurity=False).digest()[:8], "big") >> 1


def measures(text: bytes) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, line hashes, their
    words (all occurrences), their surroundings."""
    words = text.split()
    seen: set[bytes] = set()
    repeats, lines = 0, {}
    for line in text.split(b"\n"):
        own = line.split()
        if not own:
            continue
        repeats += line in seen
        seen.add(line)
        h = line_hash(b" ".join(own).translate(_NORMAL))
        lines[h] = lines.get(h, 0) + len(own)
    order = sorted(lines)[:2]
    around = [ALONE if len(order) < 2 else order[h == order[0]] for h in lines]
    return (len(words), len(b"".join(words).decode("utf-8", "replace")), len(text) - len(text.translate(None, SYMBOLS)),
            repeats, repeated_words(words), list(lines), list(lines.values()), around)


def hash_of(line: Column) -> Column:
    """``line_hash`` of the normalised ``line``, as a column."""
    words = F.array_join(F.array_remove(F.split(line, r"[\x20\x09-\x0D]+", -1), ""), " ")
    digest = F.md5(F.translate(words, "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000").cast("binary"))
    high, low = [F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for at in (1, 9)]
    return F.shiftleft(high, 31).bitwiseOR(F.shiftright(low, 1))


_MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "lines array<long>, line_words array<long>, around array<long>")


def measured(docs: DataFrame) -> DataFrame:
    """``row``, doc_id, host, text_key and the measures of every row of ``docs``."""
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 3
    names = [c.split()[0] for c in _MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measures(t.encode() if t else b"") for t in b.column(3).to_pylist()]
            cells = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *cells], ["doc_id", "host", "text_key", *names])

    narrow = docs.select("doc_id", F.col("source").cast("string").alias("host"), F.xxhash64("text").alias("text_key"), "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    found = narrow.mapInArrow(run, f"doc_id {kind}, host string, text_key long, {_MEASURES}")
    return stage(found.withColumn("row", F.monotonically_increasing_id()), "measures")


def frequent_lines(found: DataFrame, rules: Rules) -> DataFrame:
    """(f_host, f_line): lines above their host's limit."""
    hosts = found.select("host", "text_key").distinct().groupBy("host").agg(F.count("*").alias("all"))
    limit = F.greatest(F.lit(rules.min_documents).cast("double"), F.col("all") * F.lit(rules.max_share))
    hosts = hosts.select(F.col("host").alias("f_host"), limit.alias("limit"))

    def above(seen: DataFrame) -> DataFrame:
        """(f_host, f_line) of the lines with more rows than the limit in ``seen`` (host, line, ...)."""
        per_line = seen.groupBy("host", "line").agg(F.count("*").alias("documents"))
        return (per_line.where(F.col("documents") > rules.min_documents).join(hosts, F.col("host").eqNullSafe(F.col("f_host")))
                .where(F.col("documents") > F.col("limit")).select("f_host", F.col("line").alias("f_line")))

    common = stage(above(found.select("host", "text_key", F.explode("lines").alias("line")).distinct()), "common")
    whole = F.aggregate("lines", F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(h))
    one = found.select("row", "host", F.size("lines").alias("n"), whole.alias("whole"), F.explode(F.arrays_zip("lines", "around")).alias("l"))
    hits = one.join(common, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("l.lines") == F.col("f_line")))
    # the hashes of a document's lines are distinct: without the common ones their XOR is that of its own
    per_row = hits.groupBy("row", "host", "n", "whole").agg(
        F.count("*").alias("c"), F.bit_xor("l.lines").alias("x"), F.collect_list("l").alias("ls"))
    own = F.col("n") > F.col("c")
    seen = per_row.select("host", own.alias("own"), F.col("whole").bitwiseXOR(F.col("x")).alias("key"), F.explode("ls").alias("l"))
    return above(seen.select("host", F.col("l.lines").alias("line"), "own", F.when(F.col("own"), F.col("key"))
                             .otherwise(F.col("l.around")).alias("key")).distinct())


def judged(found: DataFrame, rules: Rules) -> DataFrame:
    """``found`` with base_failed, n_removed (words in removed lines), their hashes (null without) and kept."""
    lines = found.select("row", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
    often = frequent_lines(found, rules)
    removed = (lines.join(often, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("l.lines") == F.col("f_line")))
               .groupBy(F.col("row").alias("r")).agg(
                   F.sum("l.line_words").alias("n_removed"), F.collect_list("l.lines").alias("removed")))
    base = ((F.col("n_words") < rules.min_words)
            | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
    gone = F.coalesce("n_removed", F.lit(0)).cast("long")
    left = F.col("n_words") - gone
    depleted = (gone > 0) & (left < rules.enough_words) & (left < F.col("n_words") * F.lit(rules.min_left))
    return (found.join(removed, F.col("row") == F.col("r"), "left")
            .select("row", "doc_id", "host", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base.alias("base_failed"), gone.alias("n_removed"), "removed", (~base & ~depleted).alias("kept")))


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text) with its measures and verdict."""
    return judged(measured(docs), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed")


def keep_good(docs: DataFrame, rules: Rules = Rules(), length: str | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns, texts without the removed lines.

    Texts without such a line stay as they are.  ``length`` names a column to set to the number of
    code points where the text changes.  Rows are matched by doc_id, host and a hash of the text; the
    rules judge rows that agree in these alike, so repeated rows stay or go together.
    """
    columns = docs.columns
    names = [free_name(docs, f"_good_{c}") for c in ("id", "host", "text", "lines", "key")]
    good = (judged(measured(docs), rules).where("kept").groupBy("doc_id", "host", "text_key").agg(F.first("removed").alias("removed"))
            .select(*[F.col(c).alias(n) for c, n in zip(("doc_id", "host", "text_key", "removed"), names, strict=False)]))
    keyed = docs.withColumn(names[4], F.xxhash64("text"))
    both = keyed.join(good, keyed["doc_id"].eqNullSafe(good[names[0]]) & keyed["source"].cast("string").eqNullSafe(good[names[1]])
                      & (keyed[names[4]] == good[names[2]]))
    changes, gone = F.col(names[3]).isNotNull(), F.col(names[3])
    left = F.filter(F.split("text", "\n", -1), lambda x: ~F.array_contains(gone, hash_of(x)))
    out = both.withColumn("text", F.when(changes, F.array_join(left, "\n")).otherwise(F.col("text")))
    if length:
        kind = docs.schema[length].dataType
        out = out.withColumn(length, F.when(changes, F.length("text").cast(kind)).otherwise(F.col(length)))
    return out.select(*columns)
