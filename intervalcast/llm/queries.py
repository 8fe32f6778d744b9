"""The operators applied to the test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    divergence,
    edit_counts,
    exact_dedup,
    hard_negatives,
    lm,
    maxscore,
    mixing,
    pii,
    quality,
    repeats,
    simhash,
    toxicity,
)
from .common import crc_of, documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


@query(rf"""
    WITH RECURSIVE d AS (
      SELECT doc_id AS id, coalesce(source, '') AS source,
             ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS mark,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
      FROM documents),
    u AS (SELECT source, id, mark, n_tokens, count(*) AS n_rows FROM d GROUP BY ALL),
    s AS (SELECT source, sum(n_tokens * n_rows)::BIGINT AS tokens, sum(n_rows)::BIGINT AS n_docs
          FROM u GROUP BY 1),
    l AS (SELECT list(tokens / t) AS shares FROM s, (SELECT sum(tokens) AS t FROM s)
          WHERE tokens > 0),
    b AS (
      SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
      UNION ALL
      SELECT step + 1, CASE WHEN met THEN low ELSE mid END, CASE WHEN met THEN mid ELSE high END
      FROM (SELECT step, low, high, (low + high) / 2 AS mid,
                   (list_min(shares) / list_max(shares)) ** ((low + high) / 2 - 1) <= 2.0 AS met
            FROM b, l WHERE step < 36)),
    a AS (SELECT CASE WHEN list_max(shares) / list_min(shares) <= 2.0 THEN 0.0
                      ELSE round(high, 6) END AS alpha
          FROM b, l WHERE step = 36),
    p AS (SELECT s.*, CASE WHEN tokens > 0 THEN pow(tokens / sum(tokens) OVER (), alpha)
                           ELSE 0.0 END AS p FROM s, a),
    w AS (SELECT *, p / sum(p) OVER () AS weight,
                 round(p * max(CASE WHEN p > 0 THEN tokens / p END) OVER ())::BIGINT AS quota
          FROM p),
    k AS (
      SELECT u.*, ('0x' || substr(md5(concat_ws('|', 'mix', id, mark)), 1, 8))::BIGINT AS h,
             ceil(n_docs / {mixing.BLOCK})::BIGINT AS n_blocks
      FROM u JOIN w USING (source)),
    i AS (
      SELECT *, coalesce(sum(n_tokens * n_rows) OVER (
                  PARTITION BY source, block ORDER BY h, id, mark
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS inside
      FROM (SELECT *, (h * n_blocks) >> 32 AS block FROM k)),
    t AS (
      SELECT *, ('0x' || substr(md5(concat_ws('|', 'mix', epoch, source, block)), 1, 8))::BIGINT
                AS turn
      FROM (SELECT source, block, sum(n_tokens * n_rows)::BIGINT AS size FROM i GROUP BY ALL)
      JOIN (SELECT *, unnest(range(greatest(ceil(quota / greatest(tokens, 1)), 1)::BIGINT))
                      AS epoch FROM w) USING (source)),
    o AS (
      SELECT *, epoch * tokens + coalesce(sum(size) OVER (
                  PARTITION BY source, epoch ORDER BY turn, block
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS block_start
      FROM t)
    SELECT id AS doc_id, source, round(weight, 9) AS weight, quota, epoch::INTEGER AS epoch,
           block, n_tokens, n_rows, block_start + inside AS start,
           round((block_start + inside) / greatest(quota, 1), 9) AS mix_at
    FROM i JOIN o USING (source, block)
    WHERE block_start + inside < quota OR epoch = 0
""")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = mixing.Target(max_repeat=2.0)
    return mixing.mixture(documents(spark, sf_dir), target).drop("mark")


@query()
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    return bpe.decode(encoded).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(documents(spark, sf_dir))


@query()
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(documents(spark, sf_dir))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


@query()
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.all_spans(documents(spark, sf_dir))
    counts = [
        pii.count_of("spans", k).alias(f"n_{kind.name}") for k, kind in enumerate(pii.KINDS)
    ]
    together = F.array_sort(F.concat("spans", "terms"))
    return rows.select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(pii.labelled(F.col("spans")), 256).alias("base_sha256"),
        pii.labelled(together).alias("spans"),
    )


@query(r"""
    WITH d AS (
      SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
             AS text_sha256
      FROM documents),
    g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM d JOIN g USING (text_sha256)
""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(documents(spark, sf_dir))
    return groups.select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query()
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.without_repeats(documents(spark, sf_dir))
    return rows.select(
        "doc_id",
        (F.octet_length("kept") + F.col("n_removed")).alias("n_bytes"),
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query()
def op8_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return edit_counts.recounted(docs, edit_counts.cleaning_edits).drop("text")


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    net = toxicity.fit(docs, documents(spark, sf_dir, "labels"))
    held_out = crc_of() % toxicity.HELD_OUT == 0
    scored = toxicity.scored(docs, net)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query()
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rules = quality.fit(docs, documents(spark, sf_dir, "labels"))
    return quality.judged(docs, rules).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "rule",
    )


# Integer vectors of the rows that take part.
VECTORS_SQL = """
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


@query(f"""
    WITH e AS ({VECTORS_SQL} AND label IS NOT NULL),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                 list_inner_product(a.v, b.v)::BIGINT AS score
          FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id,
           (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER
             AS rank,
           id AS negative_id, positive_score, score AS negative_score
    FROM s JOIN p USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10)
    rows = documents(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", moved.otherwise(F.col("label").cast("bigint")).alias("label")
    )
    return hard_negatives.hard_negatives(rows)


@query(rf"""
    WITH d AS (
      SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
                            lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                   'abcdefghijklmnopqrstuvwxyz')) AS terms
      FROM documents),
    o AS (SELECT lang, source, unnest(terms) AS term FROM d),
    f AS (SELECT lang, unnest(list_distinct(terms)) AS term FROM d),
    k AS (SELECT lang, term FROM f GROUP BY ALL HAVING count(*) >= {divergence.LEAST_DOCS}),
    c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
    g AS (SELECT DISTINCT lang, source FROM d),
    v AS (SELECT lang, count(*) AS kept FROM k GROUP BY 1),
    n AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY 1, 2),
    t AS (SELECT lang, term, sum(n) AS total FROM c GROUP BY 1, 2),
    m AS (SELECT lang, sum(total) AS total FROM t GROUP BY 1),
    p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                 (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)::HUGEINT)
                      // (coalesce(n.total, 0) + 2 * v.kept)::HUGEINT)::BIGINT AS p,
                 (1 + (1000000000::HUGEINT * (t.total + 2)::HUGEINT)
                      // (m.total + 2 * v.kept)::HUGEINT)::BIGINT AS q
          FROM g JOIN k USING (lang) JOIN v USING (lang) JOIN t USING (lang, term) JOIN m USING (lang)
               LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
               LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    y AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
    z AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
          FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, 'pair' AS part, item, value,
           (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank
    FROM y
    UNION ALL
    SELECT lang, source, 'term', item, value,
           (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank
    FROM z QUALIFY rank <= {divergence.TOP}
""")
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir).select("text", "lang", "source"))


@query(f"""
    WITH e AS ({VECTORS_SQL}),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
          FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
           vec_id, score
    FROM s QUALIFY rank <= 5
""")
def op13_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(documents(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
