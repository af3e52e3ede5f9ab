"""One query for each operator, over its whole table with production parameters, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostpulse.llm import (
    bpe,
    centroids,
    context_tree,
    divergence,
    fingerprints,
    near_lines,
    packing,
    passages,
    pii,
    quality,
    shingles,
    toxicity,
    urls,
)
from hostpulse.llm.common import documents, remainder, stored

#: The id that ends a document in packed sequences.
END_ID = 2
#: Host, path and verdict of each rule.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def vocabulary() -> str:
    """The tokenizer file, by the path its package gives."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids of every document and of the text that they decode to."""
    return bpe.digests(documents(spark, folder), vocabulary())


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and verdict of every document; the field learns from `labels.quality`."""
    docs = documents(spark, folder)
    return quality.assess(docs, quality.train(docs, labels(spark, folder)))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels of two thirds of the ids."""
    docs = documents(spark, folder)
    held_out = remainder("doc_id", 3) == 1
    scores = toxicity.score(docs, toxicity.train(docs, labels(spark, folder), ~held_out))
    return scores.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every document, learnt from nine tenths of the ids."""
    return context_tree.score_running(documents(spark, folder), remainder("doc_id", 10) == 0)


def op5_passages(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the 400-byte strings that occur elsewhere, and its passages of 50 words that do."""
    return passages.remove(documents(spark, folder), with_passages=True)


def op6_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without lines that nearly repeat an earlier one."""
    rows = near_lines.dedup(documents(spark, folder).select("doc_id", "text"), short=True)
    return rows.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


def op7_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles have a Jaccard similarity of at least 0.85."""
    return shingles.similar(documents(spark, folder), width=4, percent=85)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack(documents(spark, folder), vocabulary(), END_ID)


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, how near they are, and the class of documents with near fingerprints."""
    return fingerprints.classes(stored(fingerprints.compare_with_next(documents(spark, folder)), "fingerprints"))


def op10_urls(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on the URL of every page."""
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return urls.judge(spark.read.parquet(f"{folder}/pages.parquet"), rules)


def op11_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document, by patterns and by a network that learns from what they find."""
    docs = documents(spark, folder)
    return pii.find(docs, pii.train(docs))


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How far the word counts of the sources of each language lie apart, and the words that stand out."""
    return divergence.audit(documents(spark, folder))


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """The cluster of every usable vector after three rounds with 16 centroids."""
    return centroids.cluster(spark.read.parquet(f"{folder}/embeddings.parquet"), k=16, rounds=3)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_bpe,
        op2_quality,
        op3_toxicity,
        op4_context_tree,
        op5_passages,
        op6_lines,
        op7_ngram_join,
        op8_packing,
        op9_simhash,
        op10_urls,
        op11_pii,
        op12_divergence,
        op13_centroids,
    )
}

_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)


def _clusters_sql(k: int, rounds: int, dims: int, scale: int) -> str:
    """The rounds one after the other, with all distances."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS line, vec_id,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS cluster, v AS c
  FROM kept QUALIFY cluster < {k}
)""",
    ]
    for turn in range(rounds + 1):
        parts.append(f"""a{turn} AS MATERIALIZED (
  SELECT line, vec_id, v, cluster,
         list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
  FROM kept CROSS JOIN c{turn}
  QUALIFY row_number() OVER (PARTITION BY line ORDER BY distance, cluster) = 1
)""")
        if turn < rounds:
            parts.append(f"""c{turn + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.c, c.c) AS c
  FROM c{turn} c LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY dim) AS c
    FROM (SELECT cluster, dim, sum(x) AS s, count(*) AS n
          FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM a{turn}) GROUP BY cluster, dim)
    GROUP BY cluster) m ON m.cluster = c.cluster
)""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.cluster"""


ORACLE_SQL: dict[str, str] = {
    "op7_ngram_join": r"""WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(
           regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\f\r]+'),
           lambda w: w <> '') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 2),
                             lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS s
  FROM words
),
elements AS (SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
       (SELECT min(b) FROM reach WHERE reach.a = sets.doc_id) AS component_id
FROM sets""",
    "op10_urls": f"""WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULE_ROWS}),
cut AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
parts AS (
  SELECT row_number() OVER () AS line, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
),
fits AS (
  SELECT line, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY line
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (line)""",
    "op12_divergence": r"""WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
),
groups AS (SELECT DISTINCT lang, source FROM docs),
words AS (
  SELECT d, lang, source,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
),
counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT d) AS docs FROM words GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL HAVING sum(docs) >= 10),
sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM cells GROUP BY ALL),
p AS MATERIALIZED (
  SELECT c.lang, c.source, c.term, c.n, CAST(1 + (1000000000 * (c.n + 2)) // (t.total + 2 * s.v) AS BIGINT) AS p
  FROM cells c JOIN totals t ON c.lang = t.lang AND c.source = t.source JOIN sizes s ON c.lang = s.lang
),
q AS (
  SELECT k.lang, k.term, CAST(1 + (1000000000 * (k.n + 2)) // (s.total + 2 * s.v) AS BIGINT) AS q
  FROM kept k JOIN sizes s ON k.lang = s.lang
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT)
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 10""",
    "op13_centroids": _clusters_sql(k=16, rounds=3, dims=64, scale=64),
}
