"""A toxicity classifier that is punished for scores that change when identity terms are swapped."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.vocabulary import release
from telemetry_lake.llm.words import words

# Groups of terms that name people; a term is swapped with the others of its group. A parameter of the training.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrant", "refugee", "citizen", "native"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("christlich", "muslimisch", "jüdisch", "hinduistisch", "buddhistisch"),
    ("femmes", "hommes", "filles", "garçons"),
    ("chrétien", "musulman", "juif", "hindou", "bouddhiste"),
    ("mujeres", "hombres", "chicas", "chicos"),
    ("cristiano", "musulmán", "judío", "hindú", "budista"),
)


@dataclass(frozen=True)
class Training:
    """Bounds and weights of the training.

    At most about ``sample`` labelled rows are used (all, if there are no more), picked by a hash of their id, and at
    most ``features`` features. ``swap_weight`` multiplies the mean squared change of the score's logit under swaps.
    """

    sample: int = 20_000
    features: int = 8_192
    least_rows: int = 3
    least_association: float = 12.0
    rounds: int = 300
    rate: float = 0.1
    decay: float = 1e-4
    swap_weight: float = 4.0
    swaps: int = 2
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS


def forms(word: str) -> list[str]:
    """A word and its beginnings of four and five letters, which words made from one stem share."""
    return [word, *(word[:n] + "*" for n in (4, 5) if len(word) > n)]


def text_features(found: set[str]) -> set[str]:
    return {f for w in found for f in forms(w)}


@dataclass
class Model:
    """Weights of features; a feature counts once in a text, however often it occurs."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, text: str | None) -> float:
        weights, seen = self.weights, {}
        for word in set(words(text)):
            for form in (word, word[:4] + "*", word[:5] + "*"):
                if form in weights and (form[-1] != "*" or len(word) >= len(form)):
                    seen[form] = weights[form]
        logit = self.bias + sum(seen[f] for f in sorted(seen))
        return float(1 / (1 + np.exp(-np.clip(logit, -40, 40))))


def held_out(doc_id: Column) -> Column:
    """Whether an id's rows are kept from training: the checksum of its digits leaves no remainder by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def swapped(found: set[str], groups: Sequence[Sequence[str]], most: int) -> list[set[str]]:
    """The words with every identity term replaced by others of its group, in up to ``most`` ways."""
    place = {t: (g, i) for g in groups for i, t in enumerate(g)}
    present = sorted(w for w in found if w in place)
    if not present:
        return []
    out = []
    for step in range(1, most + 1):
        to = {w: place[w][0][(place[w][1] + step) % len(place[w][0])] for w in present}
        out.append({to.get(w, w) for w in found})
    return out


def swap_pairs(found: set[str], groups: Sequence[Sequence[str]], most: int, turn: int) -> list[tuple[set[str], set[str]]]:
    """Up to ``most`` pairs of a text's words that differ in identity terms alone.

    A text with such terms is paired with its swaps. One without gets a term placed into it, and is paired with itself
    holding another one of the group; ``turn`` (any number, fixed for a text) picks the group and its terms.
    """
    natural = [(found, other) for other in swapped(found, groups, most)]
    if natural or not groups:
        return natural
    group = groups[turn % len(groups)]
    starts = [(turn // len(groups) + i) % len(group) for i in range(min(most, len(group) - 1))]
    return [(found | {group[i]}, found | {group[(i + 1) % len(group)]}) for i in starts]


def lone_features(one: set[str], other: set[str], shared: set[str]) -> set[str]:
    """Features of ``one`` that ``other`` lacks; ``shared`` holds the features of the words in both.

    All else in a pair of texts cancels out of the difference of their logits.
    """
    return text_features(one - other) - text_features(other - one) - shared


def _members(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """What the lists hold in a row, and the number of the list that holds it."""
    return lists.flatten().to_numpy().astype(np.int64), pc.list_parent_indices(lists).to_numpy()


def fit(rows: pa.ListArray, labels: np.ndarray, plus: pa.ListArray, minus: pa.ListArray, size: int, how: Training):
    """Bias and weights: logistic loss with weight decay, plus the squared logit differences of swapped pairs.

    ``rows`` are the features of each text, ``plus`` and ``minus`` those that only the one or the other of a pair has.
    """
    (at, owner), (plus_at, plus_owner), (minus_at, minus_owner) = map(_members, (rows, plus, minus))
    pairs, w, first, second = len(plus), np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, how.rounds + 1):
        logits = np.bincount(owner, w[at], len(rows)) + w[size]
        error = (1 / (1 + np.exp(-np.clip(logits, -40, 40))) - labels) / len(rows)
        slope = how.decay * w
        slope[:size] += np.bincount(at, error[owner], size)
        slope[size] = error.sum()
        if pairs:
            gap = np.bincount(plus_owner, w[plus_at], pairs) - np.bincount(minus_owner, w[minus_at], pairs)
            gap *= 2 * how.swap_weight / pairs
            slope[:size] += np.bincount(plus_at, gap[plus_owner], size) - np.bincount(minus_at, gap[minus_owner], size)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= how.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[size], w[:size]


def train(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Model:
    """A model of the labelled rows that are not held out.

    An id that is labelled several times is toxic if any label says so; null labels and ids count as none. Without
    labelled rows of both kinds the model knows no feature and scores by the share of toxic rows, 0.25 if there is
    no row. The sample is bounded, so its ids may be broadcast and its features reach the driver; where its ids have more
    than twice as many rows, equal rows count once and the rest is thinned by a hash of the text.
    """
    spark = docs.sparkSession
    known = (
        labels.filter("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .filter(~held_out(F.col("doc_id")))
    )
    share = min(1.0, how.sample / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select(F.col("doc_id").cast("bigint"), "text").join(F.broadcast(chosen), "doc_id")
    held = texts.select("doc_id").count()
    if held > 2 * how.sample:
        texts = texts.withColumn("_h", F.xxhash64("doc_id", "text")).filter(
            F.pmod("_h", F.lit(1 << 20)) < int(2 * how.sample / held * (1 << 20)) + 1
        ).dropDuplicates(["doc_id", "_h"]).drop("_h")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        total, toxic, rows = Counter(), Counter(), [0, 0]
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"]):
                found = text_features(set(words(text)))
                total.update(found)
                rows[0] += 1
                if label:
                    toxic.update(found)
                    rows[1] += 1
        total[""], toxic[""] = rows
        yield pd.DataFrame([(f, n, toxic[f]) for f, n in total.items()], columns=["feature", "n", "toxic"])

    counts = (
        texts.mapInPandas(counted, "feature string, n bigint, toxic bigint")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    )
    kept = counts.filter((F.col("n") >= how.least_rows) | (F.col("feature") == ""))
    size = kept.filter("feature = ''").first()
    rows, positives = (int(size["n"]), int(size["toxic"])) if size else (0, 0)
    prior = (positives + 0.5) / (rows + 2)
    if not 0 < positives < rows:
        return Model(float(np.log(prior / (1 - prior))))
    n, t = F.col("n").cast("double"), F.col("toxic").cast("double")
    # Chi-squared of a feature and the label, each row counting once.
    off = t * rows - n * positives
    association = off * off * rows / (n * (rows - n) * float(positives) * float(rows - positives))
    tied = kept.filter((F.col("feature") != "") & (F.col("n") < rows)).withColumn("a", association)
    best = tied.filter(F.col("a") >= how.least_association).orderBy(F.desc("a"), "feature").limit(how.features)
    names = sorted({r["feature"] for r in best.select("feature").collect()} | text_features({t for g in how.terms for t in g}))
    index = spark.sparkContext.broadcast({f: i for i, f in enumerate(names)})

    def indexed(features: set[str]) -> list[int]:
        return sorted(index.value[f] for f in features if f in index.value)

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, label in zip(batch["text"], batch["toxic"]):
                found = set(words(text))
                own, plus, minus = text_features(found), [], []
                for one, other in swap_pairs(found, how.terms, how.swaps, zlib.crc32((text or "").encode())):
                    shared = own if found <= other else text_features(one & other)
                    plus.append(indexed(lone_features(one, other, shared)))
                    minus.append(indexed(lone_features(other, one, shared)))
                out.append((label, indexed(own), plus, minus))
            yield pd.DataFrame(out, columns=["toxic", "own", "plus", "minus"])

    kind = "toxic int, own array<int>, plus array<array<int>>, minus array<array<int>>"
    # As Arrow arrays: millions of Python numbers would take some hundred megabytes of the driver, and leave holes in it.
    data = texts.mapInPandas(described, kind).toArrow()
    labelled, own, plus, minus = (data[name].combine_chunks() for name in ("toxic", "own", "plus", "minus"))
    bias, weights = fit(own, (labelled.to_numpy() > 0).astype(float), plus.flatten(), minus.flatten(), len(names), how)
    return Model(float(bias), {f: float(w) for f, w in zip(names, weights) if w})


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from its whole text alone.

    A null text is an empty one and has the score of a text without known features. Repeated rows have a row each.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": [sent.value.score(t) for t in batch["text"]]}
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), held_out(F.col("doc_id").cast("bigint")).alias("held_out"), "text")
    return rows.mapInPandas(scored, "doc_id bigint, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose text scores below ``limit`` (no shuffle).

    A model that knows no feature tells no text from another, and rejects none.
    """
    if not model.weights:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            fine = [sent.value.score(t.as_py()) < limit for t in batch.column("text")]
            yield batch.filter(pa.array(fine, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
