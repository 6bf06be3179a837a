"""Personal data: base patterns and bootstrapped contextual extraction, DataFrame functions only.

Base patterns give seeds: e-mail addresses, IP addresses, card numbers (Luhn) and phone
numbers.  Every seed, and every other word that looks like an identifier (a digit or @ in five
or more characters), is an instance; the words next to it are its lexical patterns (two
words before, one before, one after).  The graph of patterns and instances, with counts, is
scored in rounds:

* a pattern's confidence is the share of its instances, by count and score, that are known;
  it is kept with at least MIN_SUPPORT different known instances;
* an instance that is no seed scores 1 - prod(1 - confidence) over its kept patterns, and
  counts as known from MIN_SCORE on, as the kind of its most confident pattern, if it looks like
  the seeds of that kind: their share of digits, up to SLACK, and their length, up to a factor of 2.

What is known after ROUNDS rounds, and stands in a kept pattern, is an added span.

The expressions are forms of the contract's without backtracking, so that long texts cost
time in proportion; they find the same places (tests compare both).

Defined results: a null text counts as empty; rows that repeat a doc_id are rows of their
own; a null doc_id stays.  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.llm.common import stage
from curvelake.llm.spans import bare, count_kind, joined, matches, of_kind, places

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_CONFIDENCE = 0.9
MIN_SUPPORT = 5
MIN_SCORE = 0.9
SLACK = 0.1
CONTEXT_CHARS = 64

# A run is entered at its start, or where the last match ended inside it (\G).
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?+[0-9]){13,}+"  # shorter ones fail the digit count
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IDENTIFIER = r"[^\x20\x09-\x0D]*+"
WORDS = r"[^\x20\x09-\x0D]++"


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    each = F.transform(F.split(F.reverse(number), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def ip_ok(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(
        "^(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``base``: array of (kind, start, end, match)."""
    text = F.col("text")
    has = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9]{2}|[0-9][ -][0-9]"),
           "phone": text.contains("+")}
    regex = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select("*", *[matches(text, regex[k], has[k]).alias(k) for k in KINDS])
    docs = docs.select("doc_id", "text", *[places(text, regex[k], F.col(k)).alias(k) for k in KINDS])
    between = lambda s, low, high: F.length(digits(s)).between(low, high)
    ok = {"email": lambda s: F.lit(True), "ip": lambda s: ip_ok(s["match"]),
          "card": lambda s: between(s["match"], 14, 19) & luhn(digits(s["match"])),
          "phone": lambda s: between(s["match"], 10, 15)}
    kept = [of_kind(F.filter(k, ok[k]), k) for k in KINDS]
    return docs.select("doc_id", "text", F.concat(*kept).alias("base"))


def _plain(word: Column) -> Column:
    """A word as part of a pattern: lower case, digits made 0, outer punctuation dropped."""
    return F.regexp_replace(F.regexp_replace(F.lower(word), "[0-9]", "0"), r"^[^\p{L}0]+|[^\p{L}0]+$", "")


def with_instances(based: DataFrame) -> DataFrame:
    """row, doc_id, base and ``instances``: (kind or null, start, end, name, patterns)."""
    text = F.col("text")
    # only words with a digit or @ are looked at; a text without either has none
    regex = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D]*[0-9@])[^\x20\x09-\x0D]{5,}+"
    found = based.withColumn("m", matches(text, regex, text.rlike("[0-9@]")))
    found = found.select("doc_id", "text", "base", places(text, regex, F.col("m")).alias("words"))
    other = F.filter("words", lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    other = F.transform(other, lambda w: F.struct(F.lit(None).cast("string").alias("kind"), w["start"].alias("start"),
                                                   w["end"].alias("end"), w["match"].alias("match")))
    found = found.select("doc_id", "text", "base", F.concat("base", other).alias("all"))
    space = r"[\x20\x09-\x0D]+"

    def patterns(s: Column) -> Column:
        first = F.greatest(F.lit(0), s["start"] - CONTEXT_CHARS)
        before = F.split(F.trim(F.regexp_replace(F.substr(text, first + 1, s["start"] - first), space, " ")), " ")
        after = F.split(F.trim(F.regexp_replace(F.substr(text, s["end"] + 1, F.lit(CONTEXT_CHARS)), space, " ")), " ")
        one, two = _plain(F.try_element_at(before, F.lit(-1))), _plain(F.try_element_at(before, F.lit(-2)))
        none = F.lit("")
        return F.array(F.concat(F.lit("2<"), F.coalesce(two, none), F.lit(" "), F.coalesce(one, none)),
                       F.concat(F.lit("1<"), F.coalesce(one, none)),
                       F.concat(F.lit("1>"), F.coalesce(_plain(F.try_element_at(after, F.lit(1))), none)))

    made = F.transform("all", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.lower(F.regexp_replace(s["match"], r"^[^\p{L}0-9]+|[^\p{L}0-9]+$", "")).alias("name"), patterns(s).alias("patterns")))
    return found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "base", made.alias("instances"))


def graph(rows: DataFrame) -> DataFrame:
    """pattern, name, n, kind (null if no seed): the edges of the pattern-instance graph."""
    one = rows.select(F.explode("instances").alias("i"))
    one = one.select(F.explode("i.patterns").alias("pattern"), F.col("i.name").alias("name"), F.col("i.kind").alias("kind"))
    return one.groupBy("pattern", "name").agg(F.count("*").alias("n"), F.max("kind").alias("kind"))


def score_patterns(edges: DataFrame, known: DataFrame, min_confidence: float, min_support: int) -> DataFrame:
    """pattern, confidence, kind of the patterns kept."""
    scored = edges.drop("kind").join(known, "name", "left")
    per_kind = scored.groupBy("pattern", "kind").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("score", F.lit(0.0))).alias("sure"), F.count("score").alias("support"))
    whole = per_kind.groupBy("pattern").agg(
        (F.sum("sure") / F.sum("n")).alias("confidence"), F.sum("support").alias("support"),
        F.max(F.struct("sure", "kind"))["kind"].alias("kind"))
    return whole.where((F.col("confidence") >= min_confidence) & (F.col("support") >= min_support)).drop("support")


def digit_share(name: Column) -> Column:
    return F.length(digits(name)) / F.greatest(F.length(name), F.lit(1))


def looks(seeds: DataFrame) -> DataFrame:
    """kind, and the least and most share of digits and length of its seeds: a row per kind."""
    share, size = digit_share(F.col("name")), F.length("name")
    return seeds.groupBy(F.col("kind").alias("of")).agg(
        F.min(share).alias("low"), F.max(share).alias("high"), F.min(size).alias("short"), F.max(size).alias("long"))


def bootstrap(edges: DataFrame, rounds: int = ROUNDS, min_confidence: float = MIN_CONFIDENCE,
              min_support: int = MIN_SUPPORT, min_score: float = MIN_SCORE) -> tuple[DataFrame, DataFrame]:
    """(instances known and not seeds: name, kind, score; patterns kept) after some rounds."""
    seeds = edges.where("kind IS NOT NULL").groupBy("name").agg(F.max("kind").alias("kind")).withColumn("score", F.lit(1.0))
    profile = stage(looks(seeds), "looks")
    share, size = digit_share(F.col("name")), F.length("name")
    alike = ((F.col("kind") == F.col("of")) & share.between(F.col("low") - SLACK, F.col("high") + SLACK)
             & size.between(F.col("short") / 2, F.col("long") * 2))
    known, unseen = seeds, edges.join(seeds.select("name"), "name", "left_anti").drop("kind")
    for _ in range(rounds):
        kept = stage(score_patterns(edges, known, min_confidence, min_support), "patterns")
        miss = F.sum(F.log(1 - F.least("confidence", F.lit(0.999))))
        found = stage(unseen.join(kept, "pattern").groupBy("name")
                      .agg((1 - F.exp(miss)).alias("score"), F.max(F.struct("confidence", "kind"))["kind"].alias("kind"))
                      .where(F.col("score") >= min_score).join(profile, alike).select("name", "kind", "score"), "found")
        known = seeds.unionByName(found)
    return found, kept


def extract(docs: DataFrame, rounds: int = ROUNDS, min_confidence: float = MIN_CONFIDENCE,
            min_support: int = MIN_SUPPORT, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per row of ``docs``: doc_id, base and added: arrays of (kind, start, end)."""
    rows = stage(with_instances(base_spans(docs)), "instances")
    found, kept = bootstrap(stage(graph(rows), "graph"), rounds, min_confidence, min_support, min_score)
    one = rows.select("row", F.explode("instances").alias("i")).where("i.kind IS NULL")
    one = one.select("row", "i.start", "i.end", "i.name", F.explode("i.patterns").alias("pattern"))
    added = (one.join(found.select("name", "kind"), "name").join(kept.select("pattern"), "pattern", "left_semi")
             .select("row", "kind", "start", "end").distinct()
             .groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added")))
    none = F.array().cast("array<struct<kind:string,start:long,end:long>>")
    return (rows.select("row", "doc_id", bare(F.col("base")).alias("base")).join(added, "row", "left")
            .select("doc_id", "base", F.coalesce("added", none).alias("added")))


def summary(extracted: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans (all), n_added."""
    counts = [count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS]
    return extracted.select("doc_id", *counts, F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
                            joined(F.concat("base", "added"), KINDS).alias("spans"), F.size("added").cast("long").alias("n_added"))
