"""License scans by diagonal voting, DataFrame functions only.

Words are runs of letters, digits and characters beyond ASCII, lower-cased.  Base phrases are
counted where their words stand in a row.  For the method, all rolling ``GRAM``-word hashes of
all documents are joined to the positions of license templates.  A match votes for its
diagonal (word position less template position).  Votes are added up per diagonal, neighbouring
diagonals (up to MAX_SHIFT words apart: insertions and deletions) are merged, and so are the diagonals that
follow the first of such a group by no more words than the template has (a page header, say).  Each
group is verified on the words themselves: the share of the template whose words stand on one of the group's
diagonals.  From MIN_COVER on the template's label is found, if the words that tell licenses of a family apart agree: the
template's first version number and its words of FAMILIES stand there (each run of them on one diagonal, all
within MAX_SHIFT), and no other word of its family does.

The template side is a fixed list of TEMPLATES texts, which bounds the broadcast.

Defined results: a null text counts as empty; rows that repeat a doc_id are rows of their
own; a null doc_id stays.  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvelake.llm.common import stage

GRAM = 3
MAX_SHIFT = 3
MIN_COVER = 0.6
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# Notices of common licenses, by label.
TEMPLATES = (
    ("apache-2.0-notice",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
     "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
     "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License."),
    ("apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("mit-text",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
     "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
     "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit-line", "Released under the MIT License."),
    ("gpl-3.0-notice",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
     "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
     "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
     "details."),
    ("gpl-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("bsd-text",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
     "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
     "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
     "distribution."),
    ("cc-by-4.0-line", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0-line", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0-line", "Licensed under CC BY-SA 4.0."),
    ("mpl-2.0-notice",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)


# Lines of the other members of the families, by label.
TEMPLATES += tuple((label, line) for label, line in (
    ("gpl-2.0-line", "This work is licensed under the GNU General Public License, version 2."),
    *((f"{k}gpl-{v}-line", f"This work is licensed under the GNU {name} General Public License, version {v.removesuffix('.0')}.")
      for k, name, v in (("l", "Lesser", "2.1"), ("l", "Lesser", "3.0"), ("a", "Affero", "3.0"))),
    *((f"gpl-{v}.0-notice", dict(TEMPLATES)["gpl-3.0-notice"].replace("version 3", f"version {v}")) for v in (2,)),
    *((f"apache-{v}-line", f"Licensed under the Apache License, Version {v}.") for v in ("1.0", "1.1")),
    ("cc-by-4.0-short-line", "Licensed under CC BY 4.0."),
    *((f"cc-by-{k.lower()}-4.0-line", f"Licensed under CC BY-{k} 4.0.") for k in ("ND", "NC-SA", "NC-ND")),
    *((f"cc-by-{k}-4.0-long-line", f"This work is licensed under a Creative Commons Attribution-{name} 4.0 International License.")
      for k, name in (("nc", "NonCommercial"), ("sa", "ShareAlike"), ("nd", "NoDerivatives"),
                      ("nc-sa", "NonCommercial-ShareAlike"), ("nc-nd", "NonCommercial-NoDerivatives"))),
))

# Words that tell the members of a family apart, by how its labels begin.
_GNU = ("lesser", "affero")
FAMILIES = {"gpl": _GNU, "lgpl": _GNU, "agpl": _GNU,
            "cc-by": ("nc", "sa", "nd", "noncommercial", "sharealike", "noderivatives", "noderivs")}

# A license's own name, by how its labels begin; texts without a name in them have none.
NAMES = {"apache": "apache license", "mit-line": "mit license", "gpl": "gnu general public license",
         "lgpl": "gnu lesser general public license", "agpl": "gnu affero general public license",
         "mpl": "mozilla public license", "cc-by": ("cc by", "creative commons attribution")}

_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"  # what separates words, before lower-casing


def words_of(text: Column) -> Column:
    """The words of a text.  lower() also changes letters beyond ASCII, which stay letters
    beyond ASCII; the one that would become ASCII (the Kelvin sign) is put aside first."""
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u212b")))
    return F.array_remove(F.split(low, _BETWEEN + "+", -1), "")


def gram_hashes(words: Column) -> Column:
    """The hash of each GRAM words in a row, by position; none for fewer words."""
    gram = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(GRAM)])
    last = F.size(words) - GRAM
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), gram)).otherwise(
        F.array().cast("array<long>"))


def template_words() -> dict[str, list[str]]:
    """The words of each fixed template."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {label: re.findall(WORD, text.translate(lower)) for label, text in TEMPLATES}


def deciding(label: str, words: list[str]) -> tuple[list[list[int]], list[str]]:
    """Runs of positions of the template that have to be covered (the license's own name, its version, the
    words that tell its family's members apart), and words that must not stand in its place."""
    own = next((w for start, w in FAMILIES.items() if label.startswith(start)), ())
    first = next((i for i, w in enumerate(words) if w.isdigit()), len(words))
    last = next((i for i in range(first, len(words)) if not words[i].isdigit()), len(words))
    names = next((n for start, n in NAMES.items() if label.startswith(start)), ())
    name: range = range(0)
    for parts in ((names,) if isinstance(names, str) else names):
        size = len(parts.split())
        name = next((range(i, i + size) for i in range(len(words)) if words[i:i + size] == parts.split()), name)
    runs: list[list[int]] = []
    for i, w in enumerate(words):
        if w in own or first <= i < last or i in name:
            if runs and runs[-1][-1] == i - 1:
                runs[-1].append(i)
            else:
                runs.append([i])
    return runs, [w for w in own if w not in words]


def template_grams(spark: SparkSession) -> DataFrame:
    """label, t_at, gram: every gram position of the fixed templates."""
    rows = [F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, words)).alias("t_words"))
            for label, words in template_words().items()]
    listed = spark.range(1).select(F.inline(F.array(*rows)))
    return listed.select("label", F.posexplode(gram_hashes(F.col("t_words"))).alias("t_at", "gram"))


def base(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, row, n_words, n_base, first_word, last_word, base_labels (array)."""
    words = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("w"))
    found = [_phrase_places(phrase.split(), label) for phrase, label in PHRASES]
    placed = words.select("doc_id", "text_key", F.size("w").cast("long").alias("n_words"), F.concat(*found).alias("places"))
    return placed.select("doc_id", "text_key", "n_words", F.size("places").cast("long").alias("n_base"),
                         F.array_min("places.at").alias("first_word"), F.array_max("places.at").alias("last_word"),
                         F.array_sort(F.array_distinct("places.label")).alias("base_labels"))


def _phrase_places(parts: list[str], label: str) -> Column:
    """array of (at, label): where the words ``parts`` stand in a row in ``w``."""
    here = lambda i: F.coalesce(_all([F.get("w", i + j) == v for j, v in enumerate(parts)]), F.lit(False))
    may = F.array_contains("w", parts[-1]) & F.array_contains("w", parts[0])
    at = F.when(may, F.filter(F.sequence(F.lit(0), F.size("w") - 1), here)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def votes(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, label, diagonal, votes, low, high: matches on each diagonal, with
    the first and the last template word they touch."""
    t = template_grams(docs.sparkSession)
    words = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("w"))
    grams = words.select("doc_id", "text_key", F.posexplode(gram_hashes(F.col("w"))).alias("at", "gram"))
    hits = grams.join(F.broadcast(t), "gram")  # a fixed list: its grams are as many as its words
    return hits.groupBy("doc_id", "text_key", "label", (F.col("at") - F.col("t_at")).alias("diagonal")).agg(
        F.countDistinct("t_at").alias("votes"), F.min("t_at").alias("low"), (F.max("t_at") + GRAM - 1).alias("high"))


def merged(voted: DataFrame) -> DataFrame:
    """Groups of diagonals: doc_id, text_key, label, diagonals (array), wide.  Neighbouring ones are a
    group; where more follow within the template's length they are a wide group with it."""
    own = Window.partitionBy("doc_id", "text_key", "label").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(own) > MAX_SHIFT, F.lit(True)).cast("int")
    of = F.create_map(*[F.lit(c) for label, words in template_words().items() for c in (label, len(words))])
    longest = max(map(len, template_words().values()))
    following = F.collect_list("diagonal").over(own.rangeBetween(0, longest))
    near = F.filter(following, lambda d: d <= F.col("diagonal") + of[F.col("label")])
    groups = (voted.withColumn("apart", apart).withColumn("group", F.sum("apart").over(own)).withColumn("near", near)
              .groupBy("doc_id", "text_key", "label", "group").agg(
                  F.sort_array(F.collect_list("diagonal")).alias("diagonals"), F.min_by("near", "diagonal").alias("near")))
    more = F.array_max("near") > F.array_max("diagonals")
    both = F.when(more, F.array(F.struct("diagonals", F.lit(False).alias("wide")),
                                F.struct(F.sort_array(F.array_union("diagonals", "near")).alias("diagonals"), F.lit(True).alias("wide"))))
    both = both.otherwise(F.array(F.struct("diagonals", F.lit(False).alias("wide"))))
    return groups.select("doc_id", "text_key", "label", F.inline(both))


def verified(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """doc_id, text_key, label, start, cover: the share of the template's words that stand in
    the text on a diagonal of the group."""
    held = (groups.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("k"))
            .agg(F.collect_list(F.struct("label", "diagonals", "wide")).alias("g")))
    text = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    # repeated rows are dropped after the join: most texts have no group; the groups grow with the texts: no broadcast
    both = (text.join(held.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
            .dropDuplicates(["doc_id", "text_key"]))
    # staged: else the optimizer would put the splitting into the lambda that looks at each word
    words = stage(both.select("doc_id", "text_key", words_of(F.col("text")).alias("w"), "g"), "words")
    of_label = lambda value: F.create_map(*[c for label, own in template_words().items() for c in (F.lit(label), value(label, own))])
    listed = lambda values, kind: F.array(*map(F.lit, values)).cast(f"array<{kind}>")
    t = of_label(lambda label, own: listed(own, "string"))
    need = of_label(lambda label, own: F.array(*[listed(run, "int") for run in deciding(label, own)[0]]).cast("array<array<int>>"))
    other = of_label(lambda label, own: listed(deciding(label, own)[1], "string"))
    at = F.transform("g", lambda g: F.struct(
        g["label"].alias("label"), g["diagonals"].alias("diagonals"), g["wide"].alias("wide"), F.size(t[g["label"]]).alias("of"),
        # for each word of the template, its first place on a diagonal of the group
        F.transform(t[g["label"]], lambda v, i: F.array_min(F.filter(F.transform(g["diagonals"], lambda d: d + i), lambda p:
                    (p >= 0) & F.coalesce(F.get("w", F.greatest(p, F.lit(0)).cast("int")) == v, F.lit(False))))).alias("at")))
    each = words.select("doc_id", "text_key", "w", at.alias("e"))
    found = F.filter(F.transform("e", lambda e: F.struct(
        e["label"].alias("label"), e["diagonals"].alias("diagonals"), F.array_min(e["diagonals"]).alias("start"), e["wide"].alias("wide"),
        (F.array_max(e["diagonals"]) + e["of"]).alias("end"), F.array_min(e["at"]).alias("low"), F.array_max(e["at"]).alias("high"),
        (F.size(F.filter(e["at"], lambda p: p.isNotNull())) / e["of"]).alias("cover"))),
        lambda e: e["cover"] >= MIN_COVER)
    stands = lambda e, d, i: (d + i >= 0) & F.coalesce(
        F.get("w", F.greatest(d + i, F.lit(0)).cast("int")) == F.get(t[e["label"]], i), F.lit(False))
    run_on = lambda e, d, run: F.forall(run, lambda i: stands(e, d, i))
    decided = lambda e: F.exists(e["diagonals"], lambda d: F.forall(need[e["label"]], lambda run: F.exists(
        e["diagonals"], lambda o: o.between(d, d + MAX_SHIFT) & run_on(e, o, run))))
    place = lambda e: F.slice("w", (e["low"] + 1).cast("int"), (e["high"] - e["low"] + 1).cast("int"))
    covered = F.filter(found, lambda e: ~F.arrays_overlap(place(e), other[e["label"]]) & decided(e))
    words = each.select("doc_id", "text_key", covered.alias("c"))
    better = lambda e, o: ((o["cover"] > e["cover"]) & (o["start"] < e["end"]) & (e["start"] < o["end"])
                           & (~o["wide"] | (o["label"] == e["label"])))
    best = F.filter("c", lambda e: ~F.exists("c", lambda o: better(e, o)))
    return words.select("doc_id", "text_key", F.explode(best).alias("e")).select("doc_id", "text_key", "e.label", "e.start", "e.cover")


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels
    and labels (arrays), score (best cover, 0 without)."""
    based = stage(base(docs), "phrases")
    groups = stage(merged(votes(docs)), "diagonals")
    found = (verified(docs, groups).groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("k"))
             .agg(F.collect_set("label").alias("found"), F.max("cover").alias("cover")))
    both = based.join(found, based["doc_id"].eqNullSafe(found["d"]) & (based["text_key"] == found["k"]), "left")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>"))))
    return both.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                       labels.alias("labels"), F.coalesce("cover", F.lit(0.0)).alias("score"))


def summary(scanned: DataFrame) -> DataFrame:
    """``scanned`` with labels comma-joined."""
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                          F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")
