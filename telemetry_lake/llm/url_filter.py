"""Exact url filters without joins: cascades of Bloom filters over all keys that the urls can ask for."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.words import salted
from telemetry_lake.session import scratch_path


class Level:
    """One Bloom filter; every level of a cascade hashes in its own way."""

    def __init__(self, number: int, keys: int, bits_per_key: int = 12):
        self.number = number
        self.size = np.uint64(max(64, keys * bits_per_key))
        self.probes = max(1, round(bits_per_key * 0.69))
        self.bits = np.zeros((int(self.size) // 64 + 1) * 8, np.uint8)

    def places(self, hashes: np.ndarray, probe: int) -> np.ndarray:
        return salted(hashes, self.number * 64 + probe + 1) % self.size

    def add(self, hashes: np.ndarray) -> None:
        for probe in range(self.probes):
            at = self.places(hashes, probe)
            np.bitwise_or.at(self.bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for probe in range(self.probes):
            at = self.places(hashes[found], probe)
            found[found] = (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


class Cascade:
    """Levels in turn: listed keys, then keys that are not listed but passed so far, then listed ones that passed that.

    A key is listed if the first level that it does not pass is an unlisted one (or it passes all and the last is of
    listed keys). This is exact for listed keys and for every key of the universe that it was built over.
    """

    def __init__(self) -> None:
        self.levels: list[Level] = []

    def listed(self, hashes: np.ndarray) -> np.ndarray:
        answer = np.zeros(len(hashes), bool)
        open_ = np.arange(len(hashes))
        for number, level in enumerate(self.levels):
            passed = level.holds(hashes[open_])
            answer[open_[~passed]] = number % 2 == 1
            open_ = open_[passed]
        answer[open_] = len(self.levels) % 2 == 1
        return answer


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def build(spark: SparkSession, listed: DataFrame, universe: DataFrame, most_levels: int = 40) -> Cascade:
    """A cascade for ``listed`` among ``universe`` (both: column ``key``; null keys are none, repeated ones count once).

    The universe is read once: what passes the first level and is not listed is written to the shared folder, and the
    next levels work on that and on the listed keys, which shrink from level to level. Filters are merged on the
    executors and sent to the driver once: 12 bits a key, so the list, not the universe, bounds them.
    """
    own = listed.select("key").filter("key is not null").distinct().withColumn("hash", _hash(F.col("key")))
    cascade = Cascade()
    inside, outside = own, universe.select("key").filter("key is not null").withColumn("hash", _hash(F.col("key")))
    while True:
        number = len(cascade.levels)
        count = inside.count()
        if not count:
            return cascade
        if number == most_levels:
            raise ValueError("keys of the universe share a hash with listed ones")
        level = Level(number, count)

        def filled(batches: Iterator[pd.DataFrame], number=number, count=count) -> Iterator[pd.DataFrame]:
            part = Level(number, count)
            for batch in batches:
                part.add(batch["hash"].to_numpy().astype(np.uint64))
            words = part.bits.view("<i8")
            held = np.flatnonzero(words)
            yield pd.DataFrame({"place": held, "word": words[held]})

        # Bits meet on the executors, word by word; the driver gets one array, whatever the number of partitions.
        merged = inside.select("hash").mapInPandas(filled, "place bigint, word bigint").groupBy("place").agg(F.bit_or("word"))
        found = merged.toArrow()
        level.bits.view("<i8")[found[0].to_numpy()] = found[1].to_numpy()
        cascade.levels.append(level)
        sent = spark.sparkContext.broadcast(level)

        def passing(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = batch[sent.value.holds(batch["hash"].to_numpy().astype(np.uint64))]
                yield found.drop_duplicates("key")

        passed = outside.mapInPandas(passing, "key string, hash bigint").distinct()
        if not number:
            passed = passed.join(own.select("key"), "key", "left_anti")
        path = scratch_path(spark, "cascade")
        passed.write.parquet(path)
        inside, outside = spark.read.schema("key string, hash bigint").parquet(path), inside


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_keys(host: Column, path: Column, path_lengths: Sequence[int]) -> Column:
    """All rules (host and path in one text) that would fit: each domain above the host, each beginning of the path.

    Beginnings have the lengths that rules have, so rules may end anywhere in a path. A path beginning with
    anything but ``/`` does not occur.
    """
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    starts = F.filter(
        F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in path_lengths]), lambda p: p.isNotNull()
    )
    return F.flatten(F.transform(domains, lambda d: F.transform(starts, lambda p: F.concat(d, p))))


def judge(pages: DataFrame, block: Sequence[str], allow: Sequence[str]) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    Rules are texts as ``example.com/de/``: a host (and its subdomains) and the beginning of a path. The longest rule
    that fits decides, a block before an allow of the same text; where none fits the verdict is ``allow``. A null url,
    or one without ``://``, has an empty host and path, which no rule fits. Rules of both kinds are looked up in
    a cascade each, built over all keys that these urls ask for, so every answer is exact.
    """
    spark = pages.sparkSession
    rules = sorted({*block, *allow})
    if any("/" not in r for r in rules):
        raise ValueError("a rule needs a host and a path that starts with /")
    lengths = sorted({len(r) - r.index("/") for r in rules})
    host, path = host_and_path(F.col("url").cast("string"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    keyed = split.withColumn("keys", rule_keys(F.col("host"), F.col("path"), lengths) if lengths else F.array().cast("array<string>"))
    universe = keyed.select(F.explode("keys").alias("key"))
    of = lambda texts: spark.createDataFrame([(t,) for t in sorted(set(texts))], "key string")
    sent = spark.sparkContext.broadcast((build(spark, of(block), universe), build(spark, of(allow), universe)))

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks, allows = sent.value
        for batch in batches:
            sizes = np.array([len(h) for h in batch["hashes"]], np.int64)
            owner = np.repeat(np.arange(len(batch)), sizes)
            hashes = np.concatenate([np.empty(0, np.int64), *batch["hashes"]]).astype(np.int64).astype(np.uint64)
            bad, good = blocks.listed(hashes), allows.listed(hashes)
            rule: list[str | None] = [None] * len(batch)
            verdict = ["allow"] * len(batch)
            starts = np.cumsum(sizes) - sizes
            keys = batch["keys"].tolist()
            for at in np.flatnonzero(bad | good).tolist():
                row = int(owner[at])
                key = keys[row][at - int(starts[row])]
                if rule[row] is None or (len(key), key) > (len(rule[row]), rule[row]):
                    rule[row], verdict[row] = key, "block" if bad[at] else "allow"
            yield batch[["page_id", "host", "path"]].assign(rule=rule, verdict=verdict)

    kind = dict(pages.dtypes)["page_id"]
    with_hashes = keyed.withColumn("hashes", F.transform("keys", _hash))
    return with_hashes.mapInPandas(judged, f"page_id {kind}, host string, path string, rule string, verdict string")
