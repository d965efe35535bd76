"""Near copies by weighted MinHash from darts, banded joins and an exact check of the pairs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.vocabulary import release
from telemetry_lake.llm.words import GOLDEN, mix, runs, salted, unit, word_hashes, words
from telemetry_lake.session import scratch_path

# Edges of the regions of the plane (weight x rank) into which darts are thrown, for every element alike.
RANK_EDGES = np.array([0, 2.0**-4, 2.0**-2, *(2.0**i for i in range(40))])
WEIGHT_EDGES = np.array([0, *(2.0**i for i in range(40))])


@dataclass(frozen=True)
class Likeness:
    """Two texts are near copies if their weighted Jaccard similarity over runs of ``width`` words reaches ``least``.

    The weight of a run is how often it occurs. A signature has ``bands`` x ``rows`` coordinates; two texts of
    similarity s share a band with probability 1 - (1 - s ** rows) ** bands: 0.9999 at 0.8, 0.22 at 0.4.
    """

    width: int = 5
    least: float = 0.8
    bands: int = 24
    rows: int = 5

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


@lru_cache(4096)
def _poisson(mean: float) -> np.ndarray:
    """Distribution function of the number of darts in a region, as far as doubles tell it from 1."""
    most = int(mean + 12 * np.sqrt(mean) + 30)
    k = np.arange(1, most)
    logs = np.concatenate([[-mean], -mean + np.cumsum(np.log(mean / k))])
    return np.cumsum(np.exp(logs))


def darts(
    elements: np.ndarray, weights: np.ndarray, most_rank: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and rank of the darts that hit, and which element each hits: under its weight, of rank below ``most_rank``.

    Darts fall on the plane of every element evenly, one per unit of area on average, and are fixed by the element's
    hash; a larger weight or rank only adds darts.
    """
    hashes, ranks, hits = [np.empty(0, np.uint64)], [np.empty(0)], [np.empty(0, np.int64)]
    for r in range(int(np.searchsorted(RANK_EDGES, most_rank.max(initial=0)))):
        low, high = RANK_EDGES[r], RANK_EDGES[r + 1]
        heavy = np.flatnonzero(most_rank > low)
        for w in range(len(WEIGHT_EDGES) - 1):
            floor, ceiling = WEIGHT_EDGES[w], WEIGHT_EDGES[w + 1]
            if w:
                heavy = heavy[weights[heavy] > floor]
            if not len(heavy):
                break
            seeds = salted(elements[heavy], 64 * r + w + 1)
            thrown = np.searchsorted(_poisson((high - low) * (ceiling - floor)), unit(seeds), "right")
            total = int(thrown.sum())
            if not total:
                continue
            turn = np.arange(total) - np.repeat(np.cumsum(thrown) - thrown, thrown)
            dart = mix(np.repeat(seeds, thrown) + (turn.astype(np.uint64) + np.uint64(1)) * GOLDEN)
            whose = np.repeat(heavy, thrown)
            rank = low + (high - low) * unit(mix(dart ^ np.uint64(0xA5A5)))
            hit = rank < most_rank[whose]
            if w or weights.min() < 1:  # whole weights reach above the first region
                place = floor + (ceiling - floor) * unit(mix(dart ^ np.uint64(0x5A5A)))
                hit &= place < weights[whose]
            hashes.append(dart[hit])
            ranks.append(rank[hit])
            hits.append(whose[hit])
    return np.concatenate(hashes), np.concatenate(ranks), np.concatenate(hits)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], coordinates: int) -> np.ndarray:
    """The earliest dart (that of least rank) of every coordinate, one row per set of elements and their weights.

    No set may be empty. The sets are thrown together, since most are far smaller than what an array call costs.
    """
    out = np.zeros((len(sets), coordinates), np.uint64)
    todo = np.arange(len(sets))
    # So many darts leave a coordinate empty in about one text of eight, which then throws twice as many.
    rank = np.array([coordinates * (np.log(coordinates) + 2) / counts.sum() for _, counts in sets])
    while len(todo):
        sizes = [len(sets[i][0]) for i in todo]
        elements = np.concatenate([sets[i][0] for i in todo])
        weights = np.concatenate([sets[i][1] for i in todo])
        hashes, ranks, hits = darts(elements, weights, np.repeat(rank[todo], sizes))
        owner = np.repeat(np.arange(len(todo)), sizes)[hits]
        place = owner * coordinates + (mix(hashes ^ np.uint64(0xC3C3)) % np.uint64(coordinates)).astype(np.int64)
        least = np.full(len(todo) * coordinates, np.inf)
        np.minimum.at(least, place, ranks)
        earliest = ranks == least[place]
        drawn = np.zeros(len(least), np.uint64)
        drawn[place[earliest]] = hashes[earliest]
        out[todo] = drawn.reshape(-1, coordinates)
        todo = todo[np.isinf(least.reshape(-1, coordinates)).any(axis=1)]
        rank[todo] *= 2
    return out


def signature(elements: np.ndarray, weights: np.ndarray, coordinates: int) -> np.ndarray:
    """Signature of one set; an empty one has none."""
    return next(_thrown([(elements, weights)], coordinates))


def _thrown(sets: list[tuple[np.ndarray, np.ndarray]], coordinates: int, together: int = 16_384) -> Iterator[np.ndarray]:
    """Signature of every set in order, empty for an empty set; about ``together`` elements are thrown at once."""
    start = size = 0
    for end in range(1, len(sets) + 1):
        size += len(sets[end - 1][0])
        if size >= together or end == len(sets):
            part = sets[start:end]
            rows = iter(signatures([s for s in part if len(s[0])], coordinates))
            yield from (next(rows) if len(s[0]) else np.empty(0, np.uint64) for s in part)
            start, size = end, 0


def text_runs(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs and how often each occurs; a text shorter than a run is one run."""
    found = runs(hashes, min(width, len(hashes)) if len(hashes) else width, 5)
    kinds, counts = np.unique(found, return_counts=True)
    return kinds, counts


def text_key(text: str | None, found: list[str]) -> bytes:
    """Key of a text with the words ``found``; one without words counts by its other characters, spacing aside."""
    return xxhash.xxh3_128_digest(" ".join(found or (text or "").split()))


def features(docs: DataFrame, like: Likeness) -> DataFrame:
    """``doc_id``, ``key`` (equal for equal word rows), ``bands`` and ``runs`` of every row.

    ``runs`` are the text's runs, the n-th occurrence of one apart from the others, as sorted 32-bit hashes: shared
    ones over all of two such lists are the weighted similarity. Texts without words have no bands, so they meet
    only those of equal key.
    """

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        factors = mix(np.arange(1, like.rows + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
        for batch in batches:
            keys, sets, members = [], [], []
            for text in batch["text"]:
                found = words(text)
                kinds, counts = text_runs(word_hashes(found), like.width)
                keys.append(text_key(text, found))
                sets.append((kinds, counts))
                nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                each = mix(np.repeat(kinds, counts) + nth.astype(np.uint64) * GOLDEN)
                members.append(np.sort((each >> np.uint64(32)).astype("<u4")).tobytes())
            bands = [
                mix((signs.reshape(-1, like.rows) * factors).sum(axis=1)).astype(np.int64)
                for signs in _thrown(sets, like.coordinates)
            ]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "key": keys, "bands": bands, "runs": members})

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(
        describe, "doc_id bigint, key binary, bands array<bigint>, runs binary"
    )


def shared_runs(one: np.ndarray, other: np.ndarray) -> int:
    both = np.concatenate([one, other])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def alike(one: np.ndarray, other: np.ndarray, least: float) -> bool:
    """Whether two texts' runs reach the similarity; texts without runs are like none."""
    total = len(one) + len(other)
    if not total or min(len(one), len(other)) < least * max(len(one), len(other)):
        return False
    shared = shared_runs(one, other)
    return shared >= least * (total - shared)


def similar(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs (``a``, ``b``) whose texts are as similar as ``least``; ``texts`` has one row (``key``, ``runs``) a key."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        for batch in batches:
            kept = [
                alike(np.frombuffer(one, "<u4"), np.frombuffer(other, "<u4"), least)
                for one, other in zip(batch["runs_a"], batch["runs_b"])
            ]
            yield batch.loc[kept, ["a", "b"]]

    whole = pairs.join(texts.select(F.col("key").alias("a"), F.col("runs").alias("runs_a")), "a").join(
        texts.select(F.col("key").alias("b"), F.col("runs").alias("runs_b")), "b"
    )
    return whole.select("a", "b", "runs_a", "runs_b").mapInPandas(check, "a binary, b binary")


def _blocks(members: DataFrame, name: str, size: int) -> DataFrame:
    """Members of a bucket packed in blocks of about ``size``, as many as a bucket needs."""
    counts = members.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("_n"))
    block = F.pmod(F.xxhash64("key"), F.ceil(F.col("_n") / size)).cast("int")
    row = F.struct("key", "class", "stray", "bands", "runs")
    return (
        members.join(counts, ["band", "hash"])
        .groupBy("band", "hash", block.alias("_block"))
        .agg(F.collect_list(row).alias(name))
        .drop("_block")
    )


def strays(members: DataFrame, like: Likeness, size: int = 128) -> DataFrame:
    """Similar pairs of buckets that hold several classes: each stray against all keys of other classes.

    ``members`` has ``band, hash, key, class, stray, bands, runs``. Blocks of strays meet blocks of members of their
    bucket, and only similar pairs leave the task. A pair is looked at in the first band that its keys share.
    """

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        for batch in batches:
            kept = []
            for band, lone, others in zip(batch["band"], batch["lone"], batch["others"]):
                bands = np.array([list(o["bands"]) for o in others])
                owners = np.array([o["class"] for o in others], object)
                keys = np.array([o["key"] for o in others], object)
                done = np.array([o["stray"] for o in others], bool)
                runs_of = [np.frombuffer(o["runs"], "<u4") for o in others]
                for one in lone:
                    equal = bands == np.array(list(one["bands"]))
                    fresh = (equal.argmax(axis=1) == band) & (owners != one["class"]) & (~done | (keys > one["key"]))
                    own = np.frombuffer(one["runs"], "<u4")
                    for i in np.flatnonzero(fresh):
                        if alike(own, runs_of[i], like.least):
                            kept.append((one["key"], keys[i]))
            yield pd.DataFrame(kept, columns=["a", "b"])

    met = _blocks(members.filter("stray"), "lone", size).join(_blocks(members, "others", size), ["band", "hash"])
    return met.select("band", "lone", "others").mapInPandas(check, "a binary, b binary")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``key`` and ``class`` (the least key that it is linked to) of every key in ``edges`` (``a``, ``b``).

    Every round ties the neighbours of a key to the least of them, first the larger, then the smaller ones, until
    nothing changes; rounds follow the logarithm of the longest chain. Each round is written to the shared folder.
    """
    links = "a binary, b binary"

    def stored(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "links")
        df.write.parquet(path)
        return spark.read.schema(links).parquet(path)

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        """Neighbours (larger or smaller ones) of each key, and the key, tied to the least of all."""
        least = pairs.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        met = pairs.join(least, "a")
        tied = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_m").alias("b")) if larger else (
            met.filter(F.col("b") != F.col("_m")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
            .unionByName(least.select("a", F.col("_m").alias("b")))
        )
        return tied.filter("a != b").distinct()

    current = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    sums = [F.count(F.lit(1)), F.expr("coalesce(sum(cast(xxhash64(a, b) as decimal(38, 0))), 0)")]
    before = current.agg(*sums).first()
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both, True).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        current = stored(star(large, False))
        after = current.agg(*sums).first()
        if after == before:
            break
        before = after
    tops = current.select(F.col("b").alias("key")).distinct().select("key", F.col("key").alias("class"))
    return current.select(F.col("a").alias("key"), F.col("b").alias("class")).unionByName(tops)


def classes(spark: SparkSession, docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``doc_id``, ``class_id``, ``class_size`` and ``kept`` of every row of ``docs``.

    A class is a connected group of near copies and equal texts; its id is its least doc_id, and of the rows with
    that id one is kept. Texts without words (null ones too) are equal to each other; rows without id are in classes
    as others are, and a class of such rows alone has a null id. Only ``doc_id`` and ``text`` are read.

    Of a bucket (equal hashes of a band), one key is held against all others first; four choices of it, by the band,
    tie most of a large group with a number of pairs like its size. In a bucket that still holds several classes, all
    members outside its largest class are then held against all keys of other classes. So every pair of a bucket is
    looked at but those that are of one class already.
    """
    path = scratch_path(spark, "runs")
    features(docs, like).write.parquet(path)
    rows = spark.read.schema("doc_id bigint, key binary, bands array<bigint>, runs binary").parquet(path)

    def stored(df: DataFrame, label: str) -> DataFrame:
        place = scratch_path(spark, label)
        df.write.parquet(place)
        return spark.read.schema(df.schema).parquet(place)

    keys = rows.select("key", "bands").groupBy("key").agg(F.first("bands").alias("bands"))
    banded = keys.select("key", F.posexplode("bands").alias("band", "hash"))
    turn = F.struct(F.xxhash64(F.col("band") % 4, F.col("key")).alias("turn"), F.col("key").alias("key"))
    firsts = banded.groupBy("band", "hash").agg(F.min(turn)["key"].alias("hub"), F.count(F.lit(1)).alias("n"))
    bucket = stored(
        banded.join(firsts.filter("n > 1").drop("n"), ["band", "hash"]).select("band", "hash", "key", "hub"), "buckets"
    )
    needed = bucket.select("key").distinct()
    texts = stored(
        rows.join(needed, "key", "left_semi")
        .groupBy("key")
        .agg(F.first("runs").alias("runs"), F.first("bands").alias("bands")),
        "texts",
    )
    pairs = bucket.filter("key != hub").select(F.least("hub", "key").alias("a"), F.greatest("hub", "key").alias("b"))
    edges = stored(similar(pairs.distinct(), texts, like.least), "similar")
    grouped = stored(components(spark, edges), "classes")
    named = bucket.join(grouped, "key", "left").select("band", "hash", "key", F.coalesce("class", "key").alias("class"))
    parts = named.groupBy("band", "hash", "class").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("band", "hash").agg(
        F.max(F.struct("n", "class"))["class"].alias("largest"), F.count(F.lit(1)).alias("classes")
    )
    members = named.join(mixed.filter("classes > 1").drop("classes"), ["band", "hash"]).join(texts, "key")
    members = members.withColumn("stray", F.col("class") != F.col("largest"))
    found = stored(strays(members, like), "similar")
    if not found.isEmpty():
        # Classes so far are as good as the pairs that made them, and every key is one step from its class's least.
        ties = grouped.filter("key != class").select(F.col("key").alias("a"), F.col("class").alias("b"))
        grouped = stored(components(spark, ties.unionByName(found)), "classes")

    by_key = rows.groupBy("key").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    by_key = by_key.join(grouped, "key", "left").withColumn("class", F.coalesce("class", "key"))
    whole = by_key.groupBy("class").agg(
        F.min("least").alias("class_id"),
        F.sum("n").alias("class_size"),
        # Of several keys with the least doc_id (an id given twice) one is the class's own.
        F.min_by("key", F.struct(F.coalesce("least", F.lit(2**63 - 1)), "key")).alias("first_key"),
    )
    placed = by_key.select("key", "class").join(whole, "class").select("key", "class_id", "class_size", "first_key")
    found = rows.select("doc_id", "key").join(placed, "key")
    first = (F.col("key") == F.col("first_key")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return found.select("doc_id", "key", "class_id", "class_size", first.alias("kept"))


def without_copies(spark: SparkSession, docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """One row of every class of near copies, with all columns of ``docs``.

    The kept row has the class's least ``doc_id``; if several rows have that id and text, one of them stays.
    """
    own, key = _free_names(docs.columns, "id", "key")
    path = scratch_path(spark, "kept")
    placed = classes(spark, docs, like).select(F.col("doc_id").alias(own), F.col("key").alias(key), "kept")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    ids = placed.groupBy(own).agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept")).filter("kept")
    same = docs["doc_id"].cast("bigint").eqNullSafe(F.col(own))
    # These ids grow with the table, so they are not sent through the driver, however few they are.
    single = docs.join(ids.filter("n = 1").select(own).hint("merge"), same, "left_semi")
    repeated = ids.filter("n > 1").select(own)
    # Ids are single almost always; only rows of repeated ids (and null ones) need their text's key again.
    if repeated.isEmpty():
        return single
    # Marked as not deterministic, so that keys are made of the rows that the first join leaves, not of all texts.
    word_key = F.pandas_udf(
        lambda texts: pd.Series([text_key(t, words(t)) for t in texts], dtype=object), "binary"
    ).asNondeterministic()
    double = docs.join(repeated, same, "left_semi").withColumn(f"{key}_own", word_key("text"))
    kept = placed.filter("kept").select(own, key)
    double = double.join(kept, same & (F.col(f"{key}_own") == F.col(key)), "left_semi")
    return single.unionByName(double.dropDuplicates(["doc_id", f"{key}_own"]).drop(f"{key}_own"))


def _free_names(taken: Sequence[str], *wanted: str) -> list[str]:
    """Names for columns beside others, like the wanted ones but longer than any that is taken."""
    mark = "_" * (1 + max((len(n) for n in taken), default=0))
    return [mark + n for n in wanted]
