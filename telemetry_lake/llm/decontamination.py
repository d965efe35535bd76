"""Benchmark passages in documents, found by spaced seeds and verified with substitutions allowed."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.token_counts import balanced
from telemetry_lake.llm.words import GOLDEN, mix, runs, word_hashes, words


@dataclass(frozen=True)
class Overlap:
    """A passage counts if ``span`` words in a row of an item recur in a document with at most ``errors`` substituted.

    The span is cut in ``errors + 2`` blocks; every mask keeps two of them and ignores the other positions. As the
    substitutions leave two blocks whole, one mask at least meets such a passage wherever they lie. An item shorter
    than the span counts if all of it recurs, from ``shortest`` words on; items of fewer words never count.
    """

    span: int = 13
    errors: int = 2
    shortest: int = 5

    def blocks(self) -> list[tuple[int, int]]:
        """Start and width of each block."""
        count = self.errors + 2
        edges = [i * self.span // count for i in range(count + 1)]
        return [(a, b - a) for a, b in zip(edges, edges[1:])]

    def seeds(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        """Hashes of all windows under each mask."""
        windows = len(hashes) - self.span + 1
        parts = [runs(hashes[start:], width, 7)[:windows] for start, width in self.blocks()]
        for number, (i, j) in enumerate(itertools.combinations(range(len(parts)), 2)):
            yield mix(parts[i] + parts[j] * GOLDEN + np.uint64(number))


class Seeds:
    """Lookup of hashes: a table of bits first, then the sorted hashes."""

    def __init__(self, hashes: np.ndarray, items: np.ndarray, places: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.items, self.places = hashes[order], items[order], places[order]
        self.mask = np.uint64((1 << max(10, int(16 * len(hashes)).bit_length())) - 1)
        self.bits = np.zeros(int(self.mask) + 1, bool)
        self.bits[(hashes & self.mask).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Position in ``hashes``, item and place in the item of every equal hash."""
        maybe = np.flatnonzero(self.bits[(hashes & self.mask).astype(np.int64)])
        low = np.searchsorted(self.hashes, hashes[maybe], "left")
        high = np.searchsorted(self.hashes, hashes[maybe], "right")
        for position, first, last in zip(maybe[high > low].tolist(), low[high > low], high[high > low]):
            for i in range(first, last):
                yield position, int(self.items[i]), int(self.places[i])


class Passages:
    """The items of a benchmark with their seeds under every mask (and whole, where shorter than the span)."""

    def __init__(self, items: Sequence[tuple[object, np.ndarray]], rule: Overlap):
        self.rule = rule
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        long = [n for n, w in enumerate(self.words) if len(w) >= rule.span]
        per_mask = [list(rule.seeds(self.words[n])) for n in long]
        self.masks = []
        for mask in range(len(list(itertools.combinations(rule.blocks(), 2)))):
            if long:
                sizes = [len(s[mask]) for s in per_mask]
                places = np.concatenate([np.arange(s) for s in sizes])
                found = np.concatenate([s[mask] for s in per_mask])
                self.masks.append(Seeds(found, np.repeat(long, sizes), places))
        self.short: dict[int, Seeds] = {}
        lengths = {len(w) for w in self.words if rule.shortest <= len(w) < rule.span}
        for length in sorted(lengths):
            own = [n for n, w in enumerate(self.words) if len(w) == length]
            found = np.concatenate([runs(self.words[n], length, 7) for n in own])
            self.short[length] = Seeds(found, np.array(own), np.zeros(len(own), np.int64))

    def verified(self, doc: np.ndarray, item: int, shift: int) -> tuple[int, int, int] | None:
        """Start, length and equal words of the passage when word ``i`` of the item lies on ``i + shift``."""
        known, span = self.words[item], self.rule.span
        first, last = max(0, -shift), min(len(known), len(doc) - shift)
        equal = known[first:last] == doc[first + shift : last + shift]
        if len(equal) < span:
            return (first + shift, len(equal), int(equal.sum())) if len(known) < span and equal.all() else None
        sums = np.convolve(equal, np.ones(span, int), "valid")
        fine = np.flatnonzero(sums >= span - self.rule.errors)
        if not len(fine):
            return None
        covered = np.zeros(len(equal), bool)
        for start in fine:
            covered[start : start + span] = True
        inside = np.flatnonzero(covered & equal)
        return int(inside[0]) + first + shift, int(inside[-1] - inside[0]) + 1, len(inside)

    def search(self, docs: Sequence[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """Document, item, start, length and equal words: the longest passage of each item in each document."""
        starts = np.cumsum([0, *(len(d) for d in docs)])
        joined = np.concatenate(docs) if len(docs) else np.empty(0, np.uint64)
        tries: set[tuple[int, int, int]] = set()

        def note(seeds: Seeds, hashes: np.ndarray, width: int) -> None:
            for position, item, place in seeds.hits(hashes):
                doc = int(np.searchsorted(starts, position, "right")) - 1
                if position + width <= starts[doc + 1]:
                    tries.add((doc, item, position - int(starts[doc]) - place))

        if len(joined) >= self.rule.span and self.masks:
            for seeds, hashes in zip(self.masks, self.rule.seeds(joined)):
                note(seeds, hashes, self.rule.span)
        for length, seeds in self.short.items():
            note(seeds, runs(joined, length, 7), length)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, item, shift in sorted(tries):
            found = self.verified(docs[doc], item, shift)
            if found and found[1] > best.get((doc, item), (0, 0, 0))[1]:
                best[doc, item] = found
        for (doc, item), found in best.items():
            yield doc, item, *found


def _parts(benchmark: DataFrame, rule: Overlap, most_words: int) -> Iterator[Broadcast]:
    """The benchmark's passages, sent to the tasks in parts of about ``most_words`` words."""

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"n": [len(words(t)) for t in batch["text"]]})

    total = benchmark.select("text").mapInPandas(measured, "n bigint").agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // most_words))
    numbered = benchmark.select(F.col("item_id").cast("bigint"), "text").withColumn(
        "_part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    )
    for number in range(parts):
        rows = numbered.filter(F.col("_part") == number).select("item_id", "text").collect()
        passages = Passages([(r[0], word_hashes(words(r[1]))) for r in rows], rule)
        yield benchmark.sparkSession.sparkContext.broadcast(passages)


def overlaps(docs: DataFrame, benchmark: DataFrame, rule: Overlap = Overlap(), most_words: int = 2_000_000) -> DataFrame:
    """``doc_id, item_id, start, length, equal``: the longest passage of each item in each document that has one.

    ``start`` and ``length`` count words. The benchmark is hashed once and sent to the tasks in parts of about
    ``most_words`` words; each part meets all documents, so a benchmark of any size is searched whole. Null and empty
    texts on either side have no passage; repeated rows give a row each; equal items each count.
    """
    schema = "doc_id bigint, item_id bigint, start bigint, length bigint, equal bigint"
    result = None
    for sent in _parts(benchmark, rule, most_words):

        def search(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            held: list[tuple[object, np.ndarray]] = []
            size = 0

            def found() -> pd.DataFrame:
                hits = list(sent.value.search([h for _, h in held]))
                out = pd.DataFrame(
                    [(held[d][0], sent.value.ids[i], *rest) for d, i, *rest in hits],
                    columns=["doc_id", "item_id", "start", "length", "equal"],
                )
                return out.astype({"doc_id": "Int64", "item_id": "Int64"})

            for batch in batches:
                for known, doc_id, text in zip(batch["doc_id"].notna(), batch["doc_id"], batch["text"]):
                    hashes = word_hashes(words(text))
                    held.append((int(doc_id) if known else None, hashes))
                    size += len(hashes)
                    if size >= 50_000:
                        yield found()
                        held, size = [], 0
            if held:
                yield found()

        one = docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(search, schema)
        result = one if result is None else result.unionByName(one)
    return result


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, rule: Overlap = Overlap(), most_words: int = 2_000_000
) -> DataFrame:
    """Rows of ``docs``, with all their columns, in whose text no passage of the benchmark was found (no shuffle)."""
    for sent in _parts(benchmark, rule, most_words):

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(len(batch), bool)
                texts = batch.column("text").cast(pa.string())
                sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
                for start, stop in balanced(sizes, 400_000):
                    part = [word_hashes(words(t)) for t in texts.slice(start, stop - start).to_pylist()]
                    for doc, *_ in sent.value.search(part):
                        clean[start + doc] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
