"""Token counts of whole texts: byte-balanced batches in an Arrow function that returns lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.vocabulary import vocabulary

_MODELS: dict[str, object] = {}
# In pieces of a sentencepiece vocabulary this stands for a space.
SPACE_MARK = "▁"


def _sentencepiece(path: str):
    if path not in _MODELS:
        import sentencepiece

        _MODELS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _MODELS[path]


def safe_parts(text: str, size: int) -> list[str]:
    """Cut a long text at single spaces, so that its tokens are those of the parts in a row.

    A part starts with the space mark that the library puts before every text, in place of the space that was cut.
    No piece of the vocabulary has that mark after another character, so no token runs across such a cut. Where no
    single space comes, a part stays as long as it is.
    """
    parts, start = [], 0
    while len(text) - start > size:
        cut = start + size
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= len(text):
                return [*parts, text[start:]]
            if text[cut - 1] not in (" ", SPACE_MARK) and text[cut + 1] not in (" ", SPACE_MARK):
                break
            cut += 1
        parts.append(text[start:cut])
        start = cut + 1
    return [*parts, text[start:]]


def balanced(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of about ``most`` bytes."""
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def count_tokens(
    docs: DataFrame, model: str, limit: int = 4096, part_chars: int = 4096, batch_bytes: int = 1 << 20
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.

    ``.model`` files go to sentencepiece, others to tokenizers. A null text counts as empty; an empty one has 0 bytes
    and 0 tokens. Repeated rows give a row each. Only ``doc_id`` and ``text`` are read.
    """

    def lengths(texts: list[str]) -> list[int]:
        if not model.endswith(".model"):
            return [len(ids) for ids in vocabulary(model).encode_all(texts)]
        parts, owner = [], []
        for i, text in enumerate(texts):
            for part in safe_parts(text, part_chars):
                parts.append(part)
                owner.append(i)
        out = [0] * len(texts)
        processor = _sentencepiece(model)
        for start, stop in balanced([len(p) for p in parts], batch_bytes):
            for i, ids in zip(owner[start:stop], processor.encode(parts[start:stop], num_threads=1)):
                out[i] += len(ids)
        return out

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            n_bytes = pc.cast(pc.binary_length(pc.cast(texts, pa.large_binary())), pa.int64())
            n_tokens: list[int] = []
            for start, stop in balanced(n_bytes.to_pylist(), batch_bytes):
                n_tokens += lengths(texts.slice(start, stop - start).to_pylist())
            counted = pa.array(n_tokens, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), n_bytes, counted, pc.greater(counted, limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        count, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
