"""The registered queries of this package: opN_<name>(spark, sf_dir), on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelake.llm.common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curvelake.llm.token_files import round_trip

    return round_trip(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curvelake.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curvelake.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curvelake.llm.pii import extract, summary

    return summary(extract(table(spark, sf_dir, "documents")))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curvelake.llm.bpe import digests, encode

    tokenizer = tokenizer_file("byte_bpe_50k.json")
    return digests(encode(table(spark, sf_dir, "documents"), tokenizer), tokenizer)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curvelake.llm.secrets import scan, summary

    return summary(scan(table(spark, sf_dir, "documents")))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curvelake.llm.substring import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curvelake.llm.ann import nearest

    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curvelake.llm.licenses import scan, summary

    return summary(scan(table(spark, sf_dir, "documents")))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curvelake.llm.quality import judge

    return judge(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curvelake.llm.phrases import collocations

    return collocations(table(spark, sf_dir, "documents"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curvelake.llm.pieces import digests, encode

    path = tokenizer_file("piece_bpe_32k.model")
    return digests(encode(table(spark, sf_dir, "documents"), path), path)


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curvelake.llm.negatives import hard_negatives

    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=changed)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_mixing": op2_mixing,
    "op3_simhash": op3_simhash,
    "op4_pii": op4_pii,
    "op5_bpe": op5_bpe,
    "op6_secrets": op6_secrets,
    "op7_substring": op7_substring,
    "op8_ann": op8_ann,
    "op9_licenses": op9_licenses,
    "op10_quality": op10_quality,
    "op11_phrases": op11_phrases,
    "op12_pieces": op12_pieces,
    "op13_negatives": op13_negatives,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: DuckDB SQL of the queries that SQL can express; the others are tested against brute force.
ORACLE: dict[str, str] = {
    "op2_mixing": r"""
WITH d AS (SELECT doc_id, source, CAST(len(""" + _WORDS + r""") AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, COUNT(*) AS n,
             [3.0, 1.0, 2.0][(ROW_NUMBER() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::DOUBLE AS w
      FROM d GROUP BY source),
-- sources in the order in which they reach their cap; with the first k of them at it, the others
-- get `level` words for each unit of weight
o AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
             SUM(2.0::DOUBLE * source_size) OVER before AS capped, SUM(w) OVER rest AS weights,
             2.0::DOUBLE * source_size / w AS reach, ROW_NUMBER() OVER before AS k
      FROM s WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / w, source IS NULL, source),
                    rest AS (ORDER BY 2.0::DOUBLE * source_size / w, source IS NULL, source
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT arg_min((1.5::DOUBLE * (SELECT SUM(source_size) FROM s) - (capped - cap)) / weights, k) AS level FROM o
      WHERE (1.5::DOUBLE * (SELECT SUM(source_size) FROM s) - (capped - cap)) / weights < reach),
t AS (SELECT source, source_size, n, least(cap, w * (SELECT level FROM l)) AS target FROM o),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, d.source, t.n, md5('20:' || d.doc_id) AS draw,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS epochs
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
b AS (SELECT *, ('0x' || left(draw, 8))::BIGINT % CAST(ceil(n / 4096.0) AS BIGINT) AS bucket FROM r),
x AS (SELECT *, SUM(size) OVER (PARTITION BY source, bucket ORDER BY draw, doc_id) - size AS ahead,
             floor((epochs - floor(epochs)) * SUM(size) OVER (PARTITION BY source, bucket) + 0.5) AS share FROM b)
SELECT doc_id, size, source_size, target, source,
       CAST(floor(epochs) * size + greatest(0, least(size, share - ahead)) AS BIGINT) AS taken FROM x""",
    "op7_substring": r"""
WITH d AS (SELECT doc_id, """ + _WORDS + r""" AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50) s),
earliest AS (SELECT h, MIN(doc_id) AS m FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN earliest USING (h) WHERE m < doc_id),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, COUNT(*) AS n
         FROM word WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = word.doc_id AND gone.p = word.p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op10_quality": r"""
WITH d AS (SELECT doc_id, source AS host, text, """ + _WORDS + r""" AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5) s),
again AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (
            SELECT doc_id, unnest(range(i, i + 5)) AS p FROM (
              SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, k) AS c FROM g) s WHERE c > 1) s GROUP BY doc_id),
raw AS (SELECT doc_id, host, tkey, line, regexp_extract_all(line, '[^ 	-
]+') AS lw
        FROM (SELECT doc_id, host, md5(text) AS tkey, unnest(string_split(text, chr(10))) AS line FROM d WHERE text IS NOT NULL) s),
dup AS (SELECT doc_id, COUNT(*) - COUNT(DISTINCT line) AS n FROM raw WHERE len(lw) > 0 GROUP BY doc_id),
line AS (SELECT doc_id, host, tkey, SUM(len(lw)) AS words,
                md5(translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000')) AS h
         FROM raw WHERE len(lw) > 0 GROUP BY ALL),
-- first count: distinct texts of the host that have the line
hosts AS (SELECT host, greatest(20.0, 0.02::DOUBLE * COUNT(DISTINCT coalesce(md5(text), ''))) AS most FROM d GROUP BY host),
common AS (SELECT line.host, h FROM line JOIN hosts ON hosts.host IS NOT DISTINCT FROM line.host
           GROUP BY line.host, h, most HAVING COUNT(DISTINCT tkey) > most),
near AS (SELECT *, CASE WHEN h = MIN(h) OVER own THEN nth_value(h, 2) OVER own ELSE MIN(h) OVER own END AS around,
                EXISTS (SELECT 1 FROM common WHERE common.h = line.h AND common.host IS NOT DISTINCT FROM line.host) AS shared
         FROM line WINDOW own AS (PARTITION BY doc_id ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
-- second count: documents with the same lines of their own count once; without any, by the smallest other line
own AS (SELECT doc_id, string_agg(h, ' ' ORDER BY h) AS lines FROM near WHERE NOT shared GROUP BY doc_id),
seen AS (SELECT DISTINCT host, h, lines IS NOT NULL AS has_own, coalesce(lines, around, '') AS key
         FROM near LEFT JOIN own USING (doc_id) WHERE shared),
often AS (SELECT seen.host, h FROM seen JOIN hosts ON hosts.host IS NOT DISTINCT FROM seen.host
          GROUP BY seen.host, h, most HAVING COUNT(*) > most),
lost AS (SELECT doc_id, SUM(words) AS n FROM line WHERE EXISTS (
           SELECT 1 FROM often WHERE often.h = line.h AND often.host IS NOT DISTINCT FROM line.host) GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(coalesce(length(text) - length(translate(text, '#*$%&|<>', '')), 0) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed
      FROM d LEFT JOIN again USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND NOT (n_removed > 0 AND n_words - n_removed < 50 AND n_words - n_removed < n_words * 0.3::DOUBLE) AS kept
FROM m""",
    "op11_phrases": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, w[i:i + k - 1] AS g, k, COUNT(*) AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 5) r(k)) s GROUP BY ALL),
t AS (SELECT lang, SUM(f) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM g WHERE k > 1 AND f >= 30),
part AS (SELECT lang, g[i:i + m - 1] AS g, MAX(f) AS around
         FROM (SELECT lang, g, f, m, unnest(range(1, k - m + 2)) AS i FROM c, range(2, 4) r(m) WHERE m < k) s GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN part USING (lang, g) WHERE around IS NULL OR 100 * around < 80 * f),
cut AS (SELECT kept.lang, kept.g, kept.f AS a, x.k AS cut, x.f AS l, y.f AS r, 2000000::HUGEINT * kept.f // (x.f + y.f) AS score
        FROM kept JOIN g x ON x.lang = kept.lang AND x.k < kept.k AND x.g = kept.g[1:x.k]
                  JOIN g y ON y.lang = kept.lang AND y.k = kept.k - x.k AND y.g = kept.g[x.k + 1:]),
low AS (SELECT * FROM cut QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
best AS (SELECT *, array_to_string(g, ' ') AS phrase FROM low)
SELECT lang, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a,
       CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best JOIN t USING (lang) QUALIFY rank <= 2000""",
    "op13_negatives": r"""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
           WHERE label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other,
             CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, p.other AS positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score,
       CAST(ROW_NUMBER() OVER (PARTITION BY anchor_id, p.other ORDER BY s.score DESC, s.other) AS INTEGER) AS rank
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score QUALIFY rank <= 3""",
}
