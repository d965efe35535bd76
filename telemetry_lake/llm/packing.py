"""Best-fit packing of token pieces into sequences, after fixing sets that provably dominate all alternatives."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.positions import numbered
from telemetry_lake.llm.vocabulary import vocabulary
from telemetry_lake.session import scratch_path

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document, each document closed by ``end_id``.

    A null or empty text has the end id alone; repeated rows have pieces each; null ids stay null. Only the
    columns ``doc_id`` and ``text`` are read. ``with_ids`` adds the ids, as little-endian unsigned 32-bit integers.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = vocabulary(tokenizer)
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.concatenate([encoder.encode(text or ""), end])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity].tobytes()
                    row = (doc_id, piece, start, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(
        cut, PIECES + (", ids binary" if with_ids else "")
    )


class Packing:
    """Places for ``counts[length]`` pieces of each length in bins of ``capacity``.

    Pieces of one length are interchangeable, so the work depends on the lengths in use (at most ``capacity``) and
    never on the number of pieces. Equal bins stay together as ranges; a placement is one row: pieces of one length,
    from one rank on, into a range of bins, so many in each, from one offset on. A piece splits at most one range in
    three, and a bin holds fewer than 64 different lengths when the capacity is 2048, which bounds the rows.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, count in counts.items():
            self.left[length] = count
        self.ranks: Counter[int] = Counter()
        self.bins = 0
        self.fixed = 0
        self.rows: list[tuple[int, int, int, int, int]] = []
        self._reduce()
        self._best_fit()
        self.rows.sort()
        columns = np.array(self.rows, np.int64).reshape(-1, 5).T
        self.keys = (columns[0] << 40) + columns[1]
        self.table = columns

    def _put(self, length: int, first_bin: int, each: int, count: int, offset: int) -> None:
        self.rows.append((length, self.ranks[length], first_bin, each, offset))
        self.ranks[length] += count
        self.left[length] -= count

    def dominating(self, item: int) -> tuple[int, ...] | None:
        """A set with ``item`` that is at least as good as every other set with it, if one is certain.

        A set dominates another with the same item if the other's remaining pieces can be dealt to places of its own
        pieces that are as long: exchanging them leaves the rest of any packing possible.
        """
        others = self.left.copy()
        others[item] -= 1
        room = self.capacity - item
        lengths = np.flatnonzero(others[: room + 1])
        if not len(lengths):
            return (item,)
        largest = int(lengths[-1])
        smallest = np.repeat(lengths[:3], np.minimum(others[lengths[:3]], 3))[:3]
        if largest == room or len(smallest) < 2 or smallest[0] + smallest[1] > room:
            return item, largest  # it fills the bin, or one more piece is all that fits
        if len(smallest) > 2 and smallest.sum() <= room:
            return None
        # Two more pieces fit at most. The best second one for each first, counting none twice or more, bounds pairs.
        second = lengths[np.maximum(np.searchsorted(lengths, room - lengths, "right") - 1, 0)]
        pairs = (lengths + second)[lengths + second <= room]
        if largest >= pairs.max(initial=0):
            return item, largest
        fill = room - largest
        above = lengths[lengths > fill]
        two = np.repeat(above[:2], np.minimum(others[above[:2]], 2))[:2]
        if others[fill] >= 1 + (fill == largest) and (len(two) < 2 or two.sum() > room):
            return item, largest, fill  # of any pair that fits, one is no longer than each of the two
        return None

    def _reduce(self) -> None:
        changed = True
        while changed:
            changed = False
            for item in range(self.capacity, 0, -1):
                while self.left[item] and (found := self.dominating(item)):
                    need = Counter(found)
                    count = int(min(self.left[n] // k for n, k in need.items()))
                    offset = 0
                    for length in found:
                        self._put(length, self.bins, 1, count, offset)
                        offset += length
                    self.bins += count
                    self.fixed += count
                    changed = True

    def _best_fit(self) -> None:
        """Longest pieces first, each into the open bin with the least room that takes it."""
        capacity = self.capacity
        ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        open_at = np.zeros(capacity + 1, bool)

        def keep(room: int, first: int, count: int) -> None:
            if room and count:
                ranges[room].append((first, count))
                open_at[room] = True

        for length in range(capacity, 0, -1):
            while left := int(self.left[length]):
                tightest = np.flatnonzero(open_at[length:])
                if len(tightest):
                    room = length + int(tightest[0])
                    first, count = ranges[room].pop()
                    open_at[room] = bool(ranges[room])
                else:
                    room, first, count = capacity, self.bins, -(-left // (capacity // length))
                    self.bins += count
                each = room // length
                used = min(count, -(-left // each))
                items = min(left, used * each)
                full, rest = divmod(items, each)
                self._put(length, first, each, items, capacity - room)
                keep(room - each * length, first, full)
                if rest:
                    keep(room - rest * length, first + full, 1)
                keep(room, first + used, count - used)

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of the pieces with these ranks among those of their length."""
        at = np.searchsorted(self.keys, (length << 40) + rank, "right") - 1
        _, first_rank, first_bin, each, offset = self.table[:, at]
        along, turn = np.divmod(rank - first_rank, each)
        return first_bin + along, offset + turn * length


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``length`` from 1 to ``capacity``).

    Only the number of pieces of each length reaches the driver, ``capacity`` rows at most; pieces then find their
    place by their rank among those of their length. No piece gives no sequence.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = spark.sparkContext.broadcast(Packing(counts, capacity))
    ranked = numbered(pieces, "length", ["doc_id", "piece", "ids_crc32"], "_place")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                bins, offsets = plan.value.places(batch["length"].to_numpy(), batch["_place"].to_numpy())
                batch = batch.drop(columns="_place").assign(sequence_id=bins, offset=offsets)
                if batch["doc_id"].isna().any():
                    batch["doc_id"] = batch["doc_id"].astype("Int64")
                yield batch

    columns = ", ".join(f"{n} {t}" for n, t in pieces.dtypes)
    return ranked.mapInPandas(place, f"{columns}, sequence_id bigint, offset bigint")


def pack_documents(
    spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048
) -> DataFrame:
    """Pieces of all documents with their sequence and their offset there.

    Texts are encoded once; the pieces (ids of them left out) are written to the shared folder, so that counts and
    places come from the same rows, also when executors are lost.
    """
    path = scratch_path(spark, "pieces")
    token_pieces(docs, tokenizer, end_id, capacity).write.parquet(path)
    return pack(spark.read.schema(PIECES).parquet(path), capacity)
