"""Token ids in binary files: independent zstandard frames, a trailing seek table and a checksum per frame.

A file is a row of zstandard frames, each readable alone, and one skippable frame that every zstandard reader passes
over: the seek table and, in its last bytes, its length, its checksum and a mark. A frame's content is
``count (u32) | count x (has id u8) | count x (doc_id i64) | count x (number of ids u32) | ids (u16 or u32)``;
all integers are little-endian. Documents are never cut by a frame.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetry_lake.llm.vocabulary import vocabulary

SKIPPABLE = 0x184D2A5E
MARK = b"TKF1"
# Place and size in the file, checksum of the stored bytes, first id's number in the file, least and largest doc_id.
ENTRY = np.dtype(
    [("at", "<u8"), ("size", "<u4"), ("crc32", "<u4"), ("first", "<u8"), ("low", "<i8"), ("high", "<i8")]
)
FOOT = struct.Struct("<QII4s")
MANIFEST = "part bigint, file string, docs bigint, n_ids bigint, id_bytes int"


def _open(path: str):
    """File system and path, for local folders and whatever stores pyarrow knows."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class FrameWriter:
    """Writes documents to one file, frame by frame; memory holds one frame."""

    def __init__(self, stream, id_bytes: int, frame_bytes: int, level: int):
        self.stream, self.id_bytes, self.frame_bytes = stream, id_bytes, frame_bytes
        self.zip = zstandard.ZstdCompressor(level=level)
        self.entries: list[tuple] = []
        self.at = self.ids = self.docs = 0
        self._fresh()

    def _fresh(self) -> None:
        self.doc_ids: list[int | None] = []
        self.parts: list[bytes] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >= 1 << (8 * self.id_bytes):
            raise OverflowError(f"id {ids.max()} does not fit {self.id_bytes} bytes")
        part = ids.astype(f"<u{self.id_bytes}").tobytes()
        self.doc_ids.append(doc_id)
        self.parts.append(part)
        self.held += len(part)
        if self.held >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if not self.doc_ids:
            return
        known = np.array([d is not None for d in self.doc_ids], "u1")
        values = np.array([d or 0 for d in self.doc_ids], "<i8")
        lengths = np.array([len(p) // self.id_bytes for p in self.parts], "<u4")
        head = struct.pack("<I", len(known)) + known.tobytes() + values.tobytes() + lengths.tobytes()
        stored = self.zip.compress(head + b"".join(self.parts))
        total = int(lengths.sum(dtype="u8"))
        low, high = (values[known > 0].min(), values[known > 0].max()) if known.any() else (0, -1)
        self.entries.append((self.at, len(stored), zlib.crc32(stored), self.ids, low, high))
        self.stream.write(stored)
        self.at += len(stored)
        self.ids += total
        self.docs += len(known)
        self._fresh()

    def close(self) -> None:
        self.flush()
        table = np.array(self.entries, ENTRY).tobytes()
        foot = FOOT.pack(len(self.entries), zlib.crc32(table), self.id_bytes, MARK)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table) + FOOT.size) + table + foot)
        self.stream.close()


def seek_table(source) -> tuple[np.ndarray, int]:
    """Entries and bytes per id of an open file; a wrong mark or checksum raises."""
    source.seek(source.size() - FOOT.size)
    count, checksum, id_bytes, mark = FOOT.unpack(source.read(FOOT.size))
    if mark != MARK:
        raise ValueError("not a token file")
    source.seek(source.size() - FOOT.size - count * ENTRY.itemsize)
    table = source.read(count * ENTRY.itemsize)
    if zlib.crc32(table) != checksum:
        raise ValueError("the seek table is damaged")
    return np.frombuffer(table, ENTRY), id_bytes


def read_frame(source, at: int, size: int, checksum: int, id_bytes: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents of one frame; no other bytes of the file are read."""
    source.seek(at)
    stored = source.read(size)
    if zlib.crc32(stored) != checksum:
        raise ValueError(f"the frame at {at} is damaged")
    content = zstandard.ZstdDecompressor().decompress(stored)
    (count,) = struct.unpack_from("<I", content)
    known = np.frombuffer(content, "u1", count, 4)
    doc_ids = np.frombuffer(content, "<i8", count, 4 + count)
    lengths = np.frombuffer(content, "<u4", count, 4 + 9 * count)
    ids = np.frombuffer(content, f"<u{id_bytes}", offset=4 + 13 * count)
    for has, doc_id, end, length in zip(known, doc_ids, np.cumsum(lengths, dtype="i8"), lengths):
        yield (int(doc_id) if has else None), ids[end - length : end].astype("<u4")


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    frame_bytes: int = 1 << 20,
    level: int = 1,
    id_bytes: int = 2,
) -> DataFrame:
    """Encode all documents into files below ``path``, ascending in ``doc_id`` from file to file; give the manifest.

    Null ids come first; rows with one id lie side by side, by a hash of their text. A null text is an empty one. A
    file's name holds the task attempt, and the manifest lists those of attempts that Spark kept, so a task that is
    run again leaves nothing twice. Empty tables give no file. ``path`` must be a folder that all executors share.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, context, writer = vocabulary(tokenizer), TaskContext.get(), None
        name = f"{path}/tokens-{context.partitionId():06d}-{context.taskAttemptId()}.tkf"
        end = np.array([end_id], "<u4")
        for batch in batches:
            for known, doc_id, text in zip(batch["doc_id"].notna(), batch["doc_id"], batch["text"]):
                if writer is None:
                    store, place = _open(name)
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    writer = FrameWriter(store.open_output_stream(place), id_bytes, frame_bytes, level)
                ids = np.concatenate([encoder.encode(text or ""), end])
                writer.add(int(doc_id) if known else None, ids)
        if writer is not None:
            writer.close()
            row = (context.partitionId(), name, writer.docs, writer.ids, id_bytes)
            yield pd.DataFrame([row], columns=["part", "file", "docs", "n_ids", "id_bytes"])

    spark = docs.sparkSession
    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .withColumn("_text_hash", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_text_hash")
        .sortWithinPartitions("doc_id", "_text_hash")
        .drop("_text_hash")
    )
    ordered.mapInPandas(write, MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def frames(manifest: DataFrame) -> DataFrame:
    """One row per frame, with the number of ids before it in all files; the manifest has a row per file."""

    def tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, before in zip(batch["file"], batch["before"]):
                store, place = _open(file)
                with store.open_input_file(place) as source:
                    entries, id_bytes = seek_table(source)
                out = pd.DataFrame({n: entries[n].astype("i8") for n in ("at", "size", "crc32", "first", "low", "high")})
                yield out.assign(file=file, first=out["first"] + before, id_bytes=id_bytes)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.select("file", "before").repartition(parts, "file").mapInPandas(
        tables, "file string, at bigint, size bigint, crc32 bigint, first bigint, low bigint, high bigint, id_bytes int"
    )


def spread(table: DataFrame, manifest: DataFrame, task_bytes: int = 64 << 20) -> DataFrame:
    """Frames dealt to so many tasks that each decodes about ``task_bytes``: their rows are small, their content is not,
    so a number of partitions is stated, which Spark does not merge."""
    total = manifest.agg(F.sum(F.col("n_ids") * F.col("id_bytes"))).first()[0] or 0
    least = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.repartition(max(least, total // task_bytes), "file", "at")


def read_digests(manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the files."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                store, place = _open(row.file)
                rows, start = [], row.first
                with store.open_input_file(place) as source:
                    for doc_id, ids in read_frame(source, row.at, row.size, row.crc32, row.id_bytes):
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return spread(frames(manifest), manifest).mapInPandas(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_documents(manifest: DataFrame, doc_ids: Sequence[int]) -> DataFrame:
    """``doc_id`` and ``ids`` of the asked documents; only frames whose range of ids holds one are decompressed."""
    asked = np.unique(np.array(list(doc_ids), "i8"))

    def holding(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[np.searchsorted(asked, batch["low"]) < np.searchsorted(asked, batch["high"], "right")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = set(asked.tolist())
        for batch in batches:
            for row in batch.itertuples(index=False):
                store, place = _open(row.file)
                with store.open_input_file(place) as source:
                    found = read_frame(source, row.at, row.size, row.crc32, row.id_bytes)
                    rows = [(d, ids.astype("i8").tolist()) for d, ids in found if d in wanted]
                yield pd.DataFrame(rows, columns=["doc_id", "ids"])

    table = frames(manifest)
    picked = spread(table.mapInPandas(holding, table.schema), manifest)
    return picked.mapInPandas(read, "doc_id bigint, ids array<bigint>")
