"""One registered query per operator, over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridspark.llm import exact_dedup, fingerprints, hard_negatives, jaccard_join, language, line_rules, packing, quality, sentence_pieces, \
    sharding, substring_dedup, tokenizer_alignment, toxicity
from gridspark.llm.common import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLE_SQL[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(r"""WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM digests""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query()
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(table(spark, sf_dir))


@query()
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.groups(table(spark, sf_dir), words=3, percent=90).select("doc_id", "n_shingles", "component_id")


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir)
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir)
    return quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query()
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir)
    return language.predicted(docs, language.learn(docs))


@query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir), keep_ids=False)


@query()
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(table(spark, sf_dir))


@query()
def op10_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.checked(table(spark, sf_dir))


@query(r"""WITH texts AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts)),
windows AS (SELECT doc_id, pos, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
    lead(word, 4) OVER o, lead(word, 5) OVER o, lead(word, 6) OVER o, lead(word, 7) OVER o) AS gram,
    lead(word, 7) OVER o AS last FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
found AS (SELECT doc_id, pos, last IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram, last IS NULL) > 1 AS again FROM windows),
covered AS (SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS hit FROM found),
repeats AS (SELECT doc_id, count(*) FILTER (hit) AS n FROM covered GROUP BY doc_id),
split AS (SELECT doc_id, host, text, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos
  FROM (SELECT *, string_split(text, chr(10)) AS l FROM texts)),
lines AS (SELECT doc_id, host, text, line, pos, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    trim(regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g'),
      '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (SELECT doc_id, count(*) FILTER (k > 1) AS n
  FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS k FROM lines) GROUP BY doc_id),
frequent AS (SELECT host, norm FROM lines GROUP BY host, norm HAVING count(DISTINCT text) > 8),
removed AS (SELECT doc_id, sum(n) AS n FROM lines SEMI JOIN frequent USING (host, norm) GROUP BY doc_id),
base AS (SELECT doc_id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols FROM texts),
joined AS (SELECT b.*, coalesce(d.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    CAST(coalesce(m.n, 0) AS BIGINT) AS n_removed_words
  FROM base b LEFT JOIN dups d USING (doc_id) LEFT JOIN repeats r USING (doc_id) LEFT JOIN removed m USING (doc_id)),
rules AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM joined)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * (n_words - n_removed_words) >= 50 * n_words AS kept, n_removed_words
FROM rules""")
def op11_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.report(table(spark, sf_dir))


@query()
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer_alignment.report(table(spark, sf_dir))


@query("""WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM rows a, rows b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scores s USING (anchor_id)
WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.quantised(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved))
