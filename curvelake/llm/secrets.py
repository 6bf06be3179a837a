"""Secrets: base patterns and a randomness test battery, DataFrame functions only.

Base patterns find assignments, access keys and long hex strings.  Every other run of at least
MIN_TOKEN characters of an encoding alphabet is a candidate.  Its encoding is the smallest
alphabet that holds all its characters; its symbols are tested against a uniform source:

* chi-squared over the alphabet, standardised by its exact mean and variance for the length;
* runs above and below the middle of the alphabet;
* serial correlation of neighbouring symbols.

The three p-values are combined (Bonferroni), and a candidate looks random if the result is
at least MIN_UNIFORM.  Short texts can look random by chance, so a second test asks how likely
ordinary writing of that length would come so near to uniform: the null distribution of the
chi-squared statistic has mean and variance from the letter counts of the whole corpus (for tokens of
digits from its digit counts) and the length of the token.  The false-discovery rate of that test
is held at MAX_FALSE (Benjamini-Hochberg, on counts of p-values in fixed bins) over all candidates of the
corpus from LONG characters on, and over all shorter ones apart, so that the many long words among these
don't count against long tokens.  A candidate that passes both is an added span of kind ``random``.

For English letter counts a token of 16 characters without any repeated symbol has p = 0.011, and one of
12 has 0.036: below 17 characters nothing reaches MAX_FALSE.  MIN_TOKEN is below that for corpora
whose letters are dealt less evenly.

Defined results: a null text counts as empty; rows that repeat a doc_id are rows of their
own; a null doc_id stays.  Extra columns are ignored by ``scan`` and kept by ``redact``.  An
empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.llm.common import free_name, stage
from curvelake.llm.spans import bare, count_kind, joined, matches, of_kind, places

KINDS = ("assign", "access", "hex", "random")
MIN_TOKEN = 12
LONG = 20                  # candidates below are a family of tests of their own
MIN_UNIFORM = 0.001
MAX_FALSE = 0.01
BINS_PER_UNIT = 100        # p-values are binned by -log10(p) in hundredths

ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+[A-Za-z0-9+/_.=-]++""")
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"      # 16 characters and more; a shorter run holds no match that counts
HEX = r"[0-9a-f]{32,}+"
TOKEN = rf"(?:(?<![A-Za-z0-9+/_-])|\G)[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}+"

#: alphabets, smallest first; a token's encoding is the first that holds it
ALPHABETS = {
    "digits": string.digits, "hex": string.digits + "abcdef", "HEX": string.digits + "ABCDEF", "base32": string.ascii_uppercase + "234567",
    "letters": string.ascii_lowercase, "LETTERS": string.ascii_uppercase,
    "lower": string.digits + string.ascii_lowercase, "upper": string.digits + string.ascii_uppercase,
    "Letters": string.ascii_uppercase + string.ascii_lowercase,
    "base62": string.digits + string.ascii_uppercase + string.ascii_lowercase,
    "base64": string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/",
    "base64url": string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_",
    "mixed": string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/-_",
}


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``base``: array of (kind, start, end)."""
    text = F.col("text")
    may = {"assign": text.rlike("[:=]") & text.rlike("(?i:passw|secret|token|api)"), "access": text.contains("AKIA"),
           "hex": text.rlike("[0-9a-f]{32}")}
    regex = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    docs = docs.select(*[F.coalesce("text", F.lit("")).alias("text") if c == "text" else c for c in docs.columns])
    docs = docs.select("*", *[matches(text, regex[k], may[k]).alias(f"_{k}") for k in regex])
    docs = docs.select("*", *[places(text, regex[k], F.col(f"_{k}")).alias(f"_at_{k}") for k in regex])
    ok = {"assign": lambda s: F.length(F.regexp_extract(s["match"], ASSIGN_VALUE, 1)) >= 8}
    kept = [bare(of_kind(F.filter(f"_at_{k}", ok.get(k, lambda s: F.lit(True))), k)) for k in regex]
    return docs.withColumn("base", F.concat(*kept)).drop(*[f"_{k}" for k in regex], *[f"_at_{k}" for k in regex])


def with_candidates(based: DataFrame) -> DataFrame:
    """``based`` with ``tokens``: array of (start, end, match) outside base spans."""
    text = F.col("text")
    found = based.withColumn("_m", matches(text, TOKEN, text.rlike(rf"[A-Za-z0-9+/_-]{{{MIN_TOKEN}}}")))
    found = found.withColumn("_at", places(text, TOKEN, F.col("_m")))
    free = F.filter("_at", lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    return found.withColumn("tokens", free).drop("_m", "_at")


def upper_tail(z: Column) -> Column:
    """P(Z >= z) of the normal distribution (rational approximation, error below 1e-7)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / F.lit((2 * 3.141592653589793) ** 0.5) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def encoding(token: Column) -> Column:
    """The first alphabet that holds the token."""
    out = None
    for name, letters in ALPHABETS.items():
        holds = F.length(F.translate(token, letters, "")) == 0
        out = F.when(holds, F.lit(letters)) if out is None else out.when(holds, F.lit(letters))
    return out


def tested(tokens: DataFrame) -> DataFrame:
    """``tokens`` (token) with n, k, chi2 and p_uniform."""
    t = tokens.withColumn("alphabet", encoding(F.col("token"))).withColumn("n", F.length("token").cast("double"))
    t = t.withColumn("k", F.length("alphabet").cast("double"))
    counts = F.transform(F.split("alphabet", ""), lambda c: (F.length("token") - F.length(F.replace(F.col("token"), c, F.lit("")))).cast("double"))
    t = t.withColumn("squares", F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c))
    t = t.withColumn("x", F.transform(F.split("token", ""), lambda c: F.call_function("instr", F.col("alphabet"), c).cast("double") - 1))
    mid, mean, var = F.col("k") / 2, (F.col("k") - 1) / 2, (F.col("k") * F.col("k") - 1) / 12
    turns = F.filter("x", lambda e, i: (i > 0) & ((e >= mid) != (F.get("x", i - 1) >= mid)))
    products = F.aggregate(F.transform("x", lambda e, i: F.when(i > 0, (e - mean) * (F.get("x", i - 1) - mean)).otherwise(0.0)),
                           F.lit(0.0), lambda a, e: a + e)
    n, k = F.col("n"), F.col("k")
    t = t.withColumn("chi2", k / n * F.col("squares") - n)
    t = t.withColumn("z_chi2", (F.col("chi2") - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))
    t = t.withColumn("z_runs", (F.size(turns) - (n - 1) / 2) / (F.sqrt(n - 1) / 2))
    t = t.withColumn("z_serial", products / var / F.sqrt(n - 1))
    least = F.least(upper_tail(F.col("z_chi2")), 2 * upper_tail(F.abs("z_runs")), 2 * upper_tail(F.abs("z_serial")))
    return t.withColumn("p_uniform", F.least(F.lit(1.0), 3 * least)).drop("x", "squares", "alphabet")


def writing(docs: DataFrame) -> dict[str, tuple[float, float]]:
    """Sums of squares and of cubes of shares, over all texts: of letters (a-z, case aside) and of digits."""
    kinds = {"letters": string.ascii_lowercase, "digits": string.digits}
    low = docs.select(F.lower("text").alias("t"))
    row = low.agg(*[F.sum(F.length("t") - F.length(F.replace(F.col("t"), F.lit(c), F.lit("")))).alias(c)
                    for c in "".join(kinds.values())]).first()
    out = {}
    for kind, symbols in kinds.items():
        all_ = [row[c] or 0 for c in symbols]
        shares = [v / sum(all_) for v in all_] if sum(all_) else [1 / len(symbols)] * len(symbols)
        out[kind] = sum(s ** 2 for s in shares), sum(s ** 3 for s in shares)
    return out


def discovered(tests: DataFrame, written: dict[str, tuple[float, float]], max_false: float = MAX_FALSE,
               min_uniform: float = MIN_UNIFORM) -> DataFrame:
    """Rows of ``tests`` that are no writing, by false-discovery control, and look random."""
    n, k = F.col("n"), F.col("k")
    squares, cubes = [F.when(k == len(ALPHABETS["digits"]), F.lit(d)).otherwise(F.lit(w))
                      for d, w in zip(written["digits"], written["letters"], strict=True)]
    mean = k + k * squares * (n - 1) - n
    var = (k / n) * (k / n) * 2 * n * (n - 1) * (squares + 2 * (n - 2) * cubes - (2 * n - 3) * squares * squares)
    z = (mean - F.col("chi2")) / F.sqrt(F.greatest(var, F.lit(1e-9)))
    # -log10(p) by its expansion beyond 5 deviations, where the p-value has no digits left
    far = (z * z / 2 + F.log(z * F.lit((2 * 3.141592653589793) ** 0.5))) / F.log(F.lit(10.0))
    score = F.when(z > 5, far).otherwise(-F.log10(F.greatest(upper_tail(z), F.lit(1e-12))))
    scored = tests.withColumn("bin", F.floor(F.least(score, F.lit(1e6)) * BINS_PER_UNIT).cast("long"))
    scored = scored.withColumn("long", n >= LONG)
    bins = scored.groupBy("long", "bin").agg(F.count("*").alias("c")).where("bin IS NOT NULL")
    # distinct bins are few: p-values from 1 down to the smallest, in hundredths
    above = F.sum("c").over(Window.partitionBy("long").orderBy(F.desc("bin")))
    whole = F.sum("c").over(Window.partitionBy("long"))
    levels = (bins.withColumn("above", above).withColumn("m", whole)
              .where(F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_UNIT) <= max_false * F.col("above") / F.col("m"))
              .groupBy("long").agg(F.min("bin").alias("level")).collect())
    found = F.lit(False)
    for of in levels:  # one for long tokens, one for short ones, or none
        found = found | ((F.col("long") == F.lit(of.long)) & (F.col("bin") >= F.lit(of.level)))
    return scored.where(found & (F.col("p_uniform") >= min_uniform))


def marked(docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` but text, ``row``, base and tokens, staged."""
    found = with_candidates(base_spans(docs)).drop("text")
    return stage(found.withColumn("row", F.monotonically_increasing_id()), "tokens")


def scan(docs: DataFrame, max_false: float = MAX_FALSE, min_uniform: float = MIN_UNIFORM) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, base and added: arrays of (kind, start, end)."""
    rows = marked(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"))
    one = rows.select("row", F.explode("tokens").alias("t")).select("row", "t.start", "t.end", F.col("t.match").alias("token"))
    # a token is tested once, however many documents have it
    tests = stage(tested(one.select("token").distinct()), "tests")
    found = discovered(tests, writing(docs), max_false, min_uniform).select("token")
    added = (one.join(found, "token", "left_semi").groupBy("row")
             .agg(F.collect_list(F.struct(F.lit("random").alias("kind"), "start", "end")).alias("added")))
    none = F.array().cast("array<struct<kind:string,start:long,end:long>>")
    return rows.join(added, "row", "left").select("doc_id", "text_key", "base", F.coalesce("added", none).alias("added"))


def summary(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex (base), base_sha256, spans (all), n_added."""
    counts = [count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:3]]
    return scanned.select("doc_id", *counts, F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
                          joined(F.concat("base", "added"), KINDS).alias("spans"), F.size("added").cast("long").alias("n_added"))


def redact(docs: DataFrame, mark: str = "[SECRET]", length: str | None = None) -> DataFrame:
    """``docs`` with every span found replaced by ``mark``; all rows and columns stay, and
    texts without a span stay as they are.  ``length`` names a column to set to the number of
    code points where the text changes."""
    columns = docs.columns
    names = [free_name(docs, f"_secret_{c}") for c in ("id", "key", "spans", "text_key")]
    spans = (scan(docs).select("doc_id", "text_key", F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end")))).alias("spans")).where(F.size("spans") > 0)
        .groupBy("doc_id", "text_key").agg(F.first("spans").alias("spans"))
        .select(F.col("doc_id").alias(names[0]), F.col("text_key").alias(names[1]), F.col("spans").alias(names[2])))
    keyed = docs.withColumn(names[3], F.xxhash64("text"))
    both = keyed.join(spans, keyed["doc_id"].eqNullSafe(spans[names[0]]) & (keyed[names[3]] == spans[names[1]]), "left")
    text = F.col("text")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        kept = F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))), F.lit(mark))
        return F.struct(F.greatest(s["end"], acc["at"]).alias("at"), F.when(new, kept).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate(names[2], start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    new = F.when(F.col(names[2]).isNull(), text).otherwise(clean)
    out = both.withColumn("text", new)
    if length:
        kind = docs.schema[length].dataType
        out = out.withColumn(length, F.when(F.col(names[2]).isNull(), F.col(length)).otherwise(F.length("text").cast(kind)))
    return out.select(*columns)
