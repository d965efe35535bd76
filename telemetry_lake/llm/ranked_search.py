"""Ranked lexical search by pipelined term partitioning.

Every term has one owner, a stage; the rarest terms belong to the first. Postings (document, term, contribution) lie
with the owner of their term, cut into blocks of documents. The items travel through the owners in bundles, one per
block and group of items: a bundle holds the accumulators (documents met so far and their sums) of its items. Each
stage is a cogroup of bundles and the owner's postings of that block, which adds whole-number contributions. What can
no longer be among the best of its block, by what later owners can add at most, is dropped; the rest goes on. After
the last owner the best of all blocks are chosen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemetry_lake.session import scratch_path

# What a term is made of, once A-Z are lower-cased: digits, a-z and all beyond ASCII, character by
# character since a list is found faster than ranges, let alone their complement.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[0123456789" + LOWER + r"\x{80}-\x{10FFFF}]+"
# Stands for a document among its terms, with its number of terms; no term is empty.
WHOLE = ""
COUNTED = "doc_row bigint, doc_id bigint, length bigint, term string, tf bigint"
POSTING = "block bigint, doc_row bigint, id bigint, known boolean, term string, owner int, part bigint"
BUNDLE = (
    "items_of int, block bigint, item_row bigint, terms array<string>, owners array<int>, most array<bigint>, "
    "docs array<bigint>, ids array<bigint>, known array<boolean>, scores array<bigint>"
)


def terms(text: Column) -> Column:
    """All terms of a whole text, repeated ones too; a null text has none. Only A-Z are lower-cased."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def counted(docs: DataFrame) -> DataFrame:
    """A row per document and distinct term, with the document's number of terms, and a row ``WHOLE`` per document that
    has any.

    Documents get a number of their own, so that rows with one id stay apart; it holds once the result is written.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["terms"]
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype("i8")
            coded = lists.flatten().dictionary_encode()
            codes, words = coded.indices.to_numpy(zero_copy_only=False).astype("i8"), max(len(coded.dictionary), 1)
            pairs, tf = np.unique(np.repeat(np.arange(len(sizes)), sizes) * words + codes, return_counts=True)
            some = np.flatnonzero(sizes)
            row = pa.array(np.concatenate([pairs // words, some]))
            names = pa.concat_arrays([coded.dictionary.take(pa.array(pairs % words)), pa.array([WHOLE] * len(some), pa.string())])
            columns = [
                batch["doc_row"].take(row),
                batch["doc_id"].take(row),
                pa.array(sizes).take(row),
                names,
                pa.array(np.concatenate([tf, sizes[some]]).astype("i8")),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_row", "doc_id", "length", "term", "tf"])

    numbered = docs.select(
        F.monotonically_increasing_id().alias("doc_row"), F.col("doc_id").cast("bigint"), terms(F.col("text")).alias("terms")
    )
    return numbered.mapInArrow(count, COUNTED)


def item_terms(items: DataFrame, item_group: int) -> DataFrame:
    """(items_of, item_row, item_id, term): each term of an item once, items numbered and put in groups."""
    spark, path = items.sparkSession, scratch_path(items.sparkSession, "item_terms")
    numbered = items.select(F.monotonically_increasing_id().alias("item_row"), F.col("item_id").cast("bigint"), "text")
    numbered.select("item_row", "item_id", F.explode(F.array_distinct(terms(F.col("text")))).alias("term")).write.parquet(path)
    stored = spark.read.schema("item_row bigint, item_id bigint, term string").parquet(path)
    groups = -(-stored.select("item_row").distinct().count() // item_group) or 1
    return stored.withColumn("items_of", F.pmod(F.xxhash64("item_row"), F.lit(groups)).cast("int"))


def owner_of(frequency: Column, documents: int, owners: int) -> Column:
    """The stage that owns a term: the last one those in a quarter of the documents or more, the one before it those in
    a sixteenth or more, and so on."""
    rarity = F.floor(F.log2(F.lit(float(documents)) / frequency) / 2)
    return (F.lit(owners - 1) - F.least(rarity, F.lit(owners - 1))).cast("int")


def _stage(stage: int, k: int, last: bool):
    """Bundles of one block through one owner: adds its postings, drops what cannot be among the best ``k``.

    A document that was dropped may come back with a later posting; its sum is then below its true one, which is below
    the ``k`` sums that put it out.
    """

    def through(bundles: pd.DataFrame, postings: pd.DataFrame) -> pd.DataFrame:
        met = [np.asarray(d, "i8") for d in bundles["docs"]]
        own = postings["doc_row"].to_numpy("i8")
        rows = np.unique(np.concatenate([*met, own]))
        ids, known = np.zeros(len(rows), "i8"), np.zeros(len(rows), bool)
        at = np.searchsorted(rows, own)
        ids[at], known[at] = postings["id"].to_numpy("i8"), postings["known"].to_numpy(bool)
        codes, names = pd.factorize(postings["term"])
        order = np.argsort(codes, kind="stable")
        cuts = np.searchsorted(codes[order], np.arange(len(names) + 1))
        spots = {name: order[cuts[i] : cuts[i + 1]] for i, name in enumerate(names)}
        part, out = postings["part"].to_numpy("i8"), []
        for row, docs in zip(bundles.itertuples(index=False), met):
            old = np.searchsorted(rows, docs)
            ids[old], known[old] = row.ids, row.known
            total = np.zeros(len(rows), "i8")
            total[old] = row.scores
            for term, owner in zip(row.terms, row.owners):
                if owner == stage and term in spots:
                    total[at[spots[term]]] += part[spots[term]]
            keep = np.flatnonzero(total)
            if len(keep) > k:
                later = int(row.most[row.owners > stage].sum())
                least = np.partition(total[keep], len(keep) - k)[len(keep) - k]
                keep = keep[total[keep] + later >= least]
            if last and len(keep) > k:
                keep = keep[np.lexsort((ids[keep], known[keep], -total[keep]))[:k]]
            out.append((*row[:6], rows[keep], ids[keep], known[keep], total[keep]))
        return pd.DataFrame(out, columns=[c.split()[0] for c in BUNDLE.split(", ")])

    return through


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    owners: int = 4,
    block_docs: int = 4096,
    item_group: int = 512,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item with a score above 0.

    A null text has no terms, an empty table or an item without terms gives no rows. Rows are documents of their own,
    whatever their id, and items likewise; among equal scores null ids come first, then smaller ids, then equal ids in
    any order. Other columns are not carried, so their names are free. ``owners``, ``block_docs`` (documents of a block,
    about) and ``item_group`` (items of a bundle group, about) change no result.
    """
    spark: SparkSession = docs.sparkSession
    asked = item_terms(items, item_group)
    wanted = asked.select("term").distinct().unionByName(spark.createDataFrame([(WHOLE,)], "term string"))

    path = scratch_path(spark, "term_counts")
    counted(docs).join(wanted, "term", "left_semi").write.parquet(path)
    stored = spark.read.schema(COUNTED).parquet(path)
    documents, total = stored.filter(F.col("term") == WHOLE).agg(F.count(F.lit(1)), F.sum("tf")).first()
    if not documents:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    counts = stored.filter(F.col("term") != WHOLE)
    frequency = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2.0 * F.col("df") + 1))).cast("bigint")
    weights = frequency.select("term", weight.alias("weight"), owner_of(F.col("df"), documents, owners).alias("owner"))
    blocks = -(-documents // block_docs)
    long_text = f"50L + ((50L * length * {documents}L) div {total}L)"
    path = scratch_path(spark, "postings")
    counts.join(weights, "term").select(
        F.pmod(F.xxhash64("doc_row"), F.lit(blocks)).cast("bigint").alias("block"),
        "doc_row",
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.col("doc_id").isNotNull().alias("known"),
        "term",
        "owner",
        (F.col("weight") * F.expr(f"(1000000000L * tf) div (1000L * tf + 20L * ({long_text}))")).alias("part"),
    ).write.parquet(path)
    postings = spark.read.schema(POSTING).parquet(path)

    # With each term of an item: its owner and what it adds at most, which bounds what later owners can add.
    most = postings.groupBy("term", "owner").agg(F.max("part").alias("most"))
    plan = asked.join(most, "term").groupBy("items_of", "item_row").agg(
        F.collect_list("term").alias("terms"),
        F.collect_list("owner").alias("owners"),
        F.collect_list("most").alias("most"),
    )
    none = F.array().cast("array<bigint>")
    bundles = plan.select(
        "items_of",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"),
        "item_row",
        "terms",
        "owners",
        "most",
        none.alias("docs"),
        none.alias("ids"),
        F.array().cast("array<boolean>").alias("known"),
        none.alias("scores"),
    )
    groups = asked.select("term", F.col("items_of").alias("asked_by")).distinct()
    for stage in range(owners):
        own = postings.filter(F.col("owner") == stage).join(groups, "term").drop("owner")
        met = bundles.groupBy("items_of", "block").cogroup(own.groupBy("asked_by", "block"))
        bundles = met.applyInPandas(_stage(stage, k, stage == owners - 1), BUNDLE)

    found = bundles.select("item_row", F.inline(F.arrays_zip("docs", "ids", "known", "scores")))
    found = found.withColumn("doc_id", F.when(F.col("known"), F.col("ids")))
    best = Window.partitionBy("item_row").orderBy(F.desc("scores"), F.asc_nulls_first("doc_id"), "docs")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item_row", "item_id").distinct(), "item_row").select(
        "item_id", "rank", "doc_id", F.col("scores").alias("score")
    )
