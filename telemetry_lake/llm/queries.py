"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm import (
    byte_pairs,
    decontamination,
    main_text,
    near_copies,
    nearest,
    packing,
    ranked_search,
    shards,
    token_counts,
    token_files,
    toxicity,
    url_filter,
    whitening,
)
from telemetry_lake.session import configure, scratch_path


def ready(spark: SparkSession) -> SparkSession:
    """The session with its settings, and Arrow batches that stay small where texts or blocks of rows are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    return configure(spark)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of at most 2048 tokens, with their sequences."""
    docs = _table(ready(spark), sf_dir, "documents")
    return packing.pack_documents(spark, docs, _tokenizer("word_bpe_49k.json"), end_id=0, capacity=2048)


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector, by inner product."""
    vectors = nearest.usable(_table(ready(spark), sf_dir, "embeddings"), "vec_id", "embedding")
    queries = vectors.filter(F.col("vec_id") % 20 == 0)
    return nearest.nearest(vectors, queries, 20, nearest.Index(dimension=64))


def op3_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies, the class's size and whether it is the one that stays."""
    docs = _table(ready(spark), sf_dir, "documents")
    return near_copies.classes(spark, docs).select("doc_id", "class_id", "class_size", "kept")


def op4_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards, and where it would lie with one more."""
    return shards.shard_slots(_table(ready(spark), sf_dir, "documents"), 24)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text."""
    docs = _table(ready(spark), sf_dir, "documents")
    return token_counts.count_tokens(docs, _tokenizer("piece_bpe_32k.model"), limit=4096)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from rows that are not held out."""
    docs, labels = _table(ready(spark), sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.score_documents(docs, toxicity.train(docs, labels))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(ready(spark), sf_dir, "pages")
    return main_text.extract(pages, main_text.train(pages))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest passage of each benchmark item in each document that has one."""
    docs, benchmark = _table(ready(spark), sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontamination.overlaps(docs, benchmark)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url with the rule that fits it and the verdict."""
    pages = _table(ready(spark), sf_dir, "pages")
    return url_filter.judge(pages, block=["net/", "example.com/de/"], allow=["example.net/en/", "org/fr/"])


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents' ids, read back from the token files."""
    docs = _table(ready(spark), sf_dir, "documents")
    path = scratch_path(spark, "token_files")
    return token_files.read_digests(token_files.write_token_files(docs, path, _tokenizer("byte_bpe_50k.json"), end_id=2))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings projected on their 16 largest principal components, with unit variance."""
    vectors = _table(ready(spark), sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors, 16))


def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every whole text, and of what they decode to."""
    import public_tokenizers

    ranks = byte_pairs.Ranks(_tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_pairs.digests(_table(ready(spark), sf_dir, "documents"), ranks)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    docs, items = _table(ready(spark), sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return ranked_search.rank(docs, items, k=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_nearest_neighbours,
        op3_near_copies,
        op4_hash_tree_shards,
        op5_token_counts,
        op6_toxicity,
        op7_main_text,
        op8_decontamination,
        op9_url_filter,
        op10_token_files,
        op11_whitening,
        op12_byte_pairs,
        op13_ranked_search,
    )
}

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

URL_FILTER_SQL = f"""
WITH rules(rh, rp, v) AS (VALUES {", ".join(str(r) for r in RULES)}),
rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
),
split AS (
  SELECT page_id,
    translate(regexp_extract(r, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
),
fit AS (
  SELECT page_id, host, path, rh || rp AS rule, v
  FROM split LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, coalesce(max_by(v, length(rule)), 'allow') AS verdict
FROM fit GROUP BY page_id, host, path
"""

RANKED_SEARCH_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents WHERE text IS NOT NULL
),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
lengths AS (SELECT r, doc_id, count(*) AS n FROM words GROUP BY r, doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
counted AS (SELECT r, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
  FROM counted, totals GROUP BY term, docs
),
parts AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))) AS part
  FROM counted JOIN weights USING (term) JOIN lengths USING (r), totals
),
scores AS (SELECT item_id, r, doc_id, sum(part)::BIGINT AS score FROM asked JOIN parts USING (term) GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r)::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLES: dict[str, str] = {"op9_url_filter": URL_FILTER_SQL, "op13_ranked_search": RANKED_SEARCH_SQL}
