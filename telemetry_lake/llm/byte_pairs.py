"""Byte-level BPE by Spark's higher-order functions, over distinct words only.

A text is cut by the pattern of the rank file into words, once: each task puts its texts into bundles, in which the
distinct words are numbered and a text is a row of those numbers; bundles are written to the shared folder. The frequent
words of all bundles are counted, merged once and sent to the tasks as a bounded table. Words of a bundle that are not in
the table are merged in its row by the same column function, and each text takes the ids of its words by number. No text
is shuffled.

The merge (``merged``) folds over the bytes of a word, held as a string with one character per byte: as long as two
neighbours make up a token, those of the lowest rank, the leftmost first, become one. Ranks are looked up in a literal
map, cut into buckets by hash since Spark searches a map from its start.
"""

from __future__ import annotations

import base64
import itertools
import json
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.llm.vocabulary import NOT_PLAIN, WITH_SPACE
from telemetry_lake.session import scratch_path

BUCKETS = 1 << 16
# Words in the table that is sent to tasks, at most; their length in bytes, at most; words of a bundle, about.
TABLE_WORDS = 2_000_000
LONG_WORD = 256
BUNDLE_WORDS = 1_000_000
# Words that are put in a row at once, about: a worker holds the texts of so many, not of a whole bundle.
PORTION_WORDS = 1 << 17
# Fixed value: the pattern that the plain expression of the vocabularies' helper equals on plain characters.
GPT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Numbers(dict):
    """A number for every word met, in order."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


@dataclass(frozen=True)
class Ranks:
    """A rank file (``base64-token rank`` lines) with the pattern that cuts texts into words.

    Every single byte must be a token, and a token's rank is its id.
    """

    path: str
    pattern: str
    table: dict[bytes, int] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        with open(self.path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        object.__setattr__(self, "table", {base64.b64decode(token): int(rank) for token, rank in pairs})

    @cached_property
    def rank_map(self) -> str:
        """Buckets of tokens, one character per byte, with their ranks, as JSON."""
        buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
        for token, rank in self.table.items():
            spelled = token.decode("latin-1")
            buckets[xxhash.xxh64_intdigest(spelled.encode(), seed=42) % BUCKETS][spelled] = rank
        return json.dumps(buckets)

    def listed(self, spell: Callable[[int, bytes], str]) -> str:
        """A text per id, as JSON; ids without a token have none."""
        texts: list[str | None] = [None] * (max(self.table.values(), default=-1) + 1)
        for token, rank in self.table.items():
            texts[rank] = spell(rank, token)
        return json.dumps(texts)

    @cached_property
    def pieces(self) -> str:
        return self.listed(lambda _, token: token.hex())

    @cached_property
    def packed(self) -> str:
        """Ids as little-endian unsigned 32-bit integers, in hexadecimal."""
        return self.listed(lambda rank, _: rank.to_bytes(4, "little").hex())


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """A value under a name inside a higher-order function, so that it is computed once.

    The name is the state of a fold over nothing: an element of ``transform`` would do, but its results are copied whole.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, use)


def _lookup(table: Column, token: Column) -> Column:
    """Rank of a token, null if it is none."""
    bucket = F.get(table, F.xxhash64(token).bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))
    return F.element_at(bucket, token)


def merged(table: Column, text: Column) -> Column:
    """Ids of one word. ``table`` is the bucketed rank map; a word that is a token is that token.

    The state of the fold is two lists: the ends of the parts of the word, and the rank of each part with the next one.
    """

    def fold(word: Column) -> Column:
        size = F.length(word)

        def between(begin: Column, end: Column) -> Column:
            return _lookup(table, F.substr(word, begin + 1, end - begin))

        def merge(ends: Column, ranks: Column, at: Column) -> Column:
            """The parts numbered ``at`` and ``at + 1`` (from 1) as one, and the ranks beside it looked up anew."""

            def joined(q: Column) -> Column:
                after = F.when(at + 2 <= F.size(ends), between(q["begin"], F.get(ends, at + 1)))
                before = between(F.when(at > 2, F.get(ends, at - 3)).otherwise(0), q["end"])
                new = F.when(at > 1, F.concat(F.slice(ranks, 1, at - 2), F.array(before, after))).otherwise(F.array(after))
                return F.struct(
                    F.array_remove(ends, q["gone"]).alias("ends"),
                    F.concat(new, F.slice(ranks, at + 2, F.size(ranks))).alias("ranks"),
                )

            around = F.struct(
                F.when(at > 1, F.get(ends, at - 2)).otherwise(0).alias("begin"),
                F.get(ends, at - 1).alias("gone"),
                F.get(ends, at).alias("end"),
            )
            return _let(around, joined)

        def step(state: Column, _: Column) -> Column:
            ends, ranks = state["ends"], state["ranks"]
            return _let(
                F.array_min(ranks),
                lambda low: F.when(
                    low.isNotNull(), _let(F.array_position(ranks, low).cast("int"), lambda at: merge(ends, ranks, at))
                ).otherwise(state),
            )

        def start(i: Column) -> Column:
            return F.when(i < size, _lookup(table, F.substr(word, i, F.lit(2))))

        places = F.sequence(F.lit(1), size)
        state = F.aggregate(
            F.sequence(F.lit(2), size), F.struct(places.alias("ends"), F.transform(places, start).alias("ranks")), step
        )
        ids = _let(
            state["ends"],
            lambda ends: F.transform(
                ends, lambda end, i: between(F.when(i > 0, F.get(ends, i - 1)).otherwise(0), end)
            ),
        )
        return _let(_lookup(table, word), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(ids))

    return _let(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), fold)


def _rank_map(ranks: Ranks) -> Column:
    return F.from_json(F.lit(ranks.rank_map), "array<map<string,int>>")


def encode_words(words: DataFrame, ranks: Ranks, column: str = "word", output: str = "ids") -> DataFrame:
    """Add the ids of the word in ``column``, which must be one match of the pattern; null stays null."""
    word = F.when(F.length(F.col(column)) == 0, F.lit(None)).otherwise(F.col(column))
    ids = _let(_rank_map(ranks), lambda table: merged(table, word))
    empty = F.array().cast("array<int>")
    return words.withColumn(output, F.when(word.isNotNull(), ids).when(F.col(column).isNotNull(), empty))


class Splitter:
    """Cuts texts into words as the library does, with its own letters, numbers and white space.

    Texts of plain characters, whose class is the same in every Unicode version, go by a plain expression. For the
    others the library is asked which code points it takes for each class; those on which the regex module thinks
    otherwise are written into the pattern.
    """

    def __init__(self, pattern: str):
        import regex

        self.plain = WITH_SPACE.findall if pattern == GPT_PATTERN else None
        self.pattern = pattern
        self.regex = regex
        self.exact = None

    def _exact(self):
        import tiktoken

        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        alone = {bytes([b]): b for b in range(256)}
        out = self.pattern
        for kind, other in ((r"\p{L}", r"\P{L}"), (r"\p{N}", r"\P{N}"), (r"\s", r"\S")):
            probe = tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks=alone, special_tokens={})
            taken = set(bytes(probe.encode_ordinary(every)).decode())
            here = set(self.regex.findall(kind, every))
            lacking, beyond = ("".join(f"\\U{ord(c):08x}" for c in sorted(part)) for part in (taken - here, here - taken))
            if lacking or beyond:
                held = f"[{kind}{lacking}]" if lacking else kind
                held = f"[{held}--[{beyond}]]" if beyond else held
                out = out.replace(other, f"[^{held}]").replace(kind, held)
        return self.regex.compile(out, self.regex.V1).findall

    def __call__(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.plain is not None and not NOT_PLAIN.search(text):
            return self.plain(text)
        if self.exact is None:
            self.exact = self._exact()
        return self.exact(text)


_SPLITTERS: dict[str, Splitter] = {}


def splitter(pattern: str) -> Splitter:
    """The splitter of a pattern, made once per Python worker."""
    if pattern not in _SPLITTERS:
        _SPLITTERS[pattern] = Splitter(pattern)
    return _SPLITTERS[pattern]


def frequent_words(bundles: DataFrame, ranks: Ranks, at_most: int = TABLE_WORDS) -> DataFrame:
    """(word, hash, ids) of the words that occur most, every word counted: those of at least ``2**t`` occurrences, with the
    least ``t`` from 1 on that leaves ``at_most`` words, in order of ``hash``, as ``Lookup`` needs it. Words longer than
    ``LONG_WORD`` bytes are left out."""
    spark = bundles.sparkSession
    each = bundles.select(F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("count"))))
    found = each.groupBy("word").agg(F.sum("count").alias("count"))
    path = scratch_path(spark, "word_counts")
    repeated = (F.col("count") > 1) & (F.octet_length("word") <= LONG_WORD)
    found.filter(repeated).write.parquet(path)
    counts = spark.read.schema("word string, count bigint").parquet(path)
    power = F.floor(F.log2("count")).cast("int")
    sizes = dict(map(tuple, counts.groupBy(power.alias("power")).count().collect()))  # 63 rows at most
    least, held = 64, 0
    while least > 1 and held + sizes.get(least - 1, 0) <= at_most:
        least -= 1
        held += sizes.get(least, 0)
    words = counts.filter(power >= least).select("word", F.xxhash64("word").alias("hash"))
    return encode_words(words.orderBy("hash"), ranks)


def _column(table: pa.Table, name: str) -> pa.Array:
    """A column in one piece, not copied if it is one already."""
    parts = table[name]
    return parts.chunk(0) if parts.num_chunks == 1 else parts.combine_chunks()


class Lookup:
    """Places of words in a table of words: by a hash of each word in order, verified by the words themselves.

    A table in order of its own column ``hash`` (Spark's ``xxhash64`` of the word) is taken as it is, so that a worker
    holds nothing beside what was sent; another one is hashed here.
    """

    def __init__(self, table: pa.Table):
        self.table = table  # held, so that its identity stays its own
        self.words, self.ids = _column(table, "word"), _column(table, "ids")
        if "hash" in table.column_names:
            self.hashes, self.order = _column(table, "hash").to_numpy(), None
        else:
            hashes = self._hashes(self.words)
            self.order = np.argsort(hashes, kind="stable")
            self.hashes = hashes[self.order]

    @staticmethod
    def _hashes(words: pa.Array) -> np.ndarray:
        # Part by part: Python strings of the whole table would take some hundred megabytes of each worker.
        parts = (words.slice(start, 1 << 14).to_pylist() for start in range(0, len(words), 1 << 14))
        return np.fromiter((xxhash.xxh64_intdigest(w, 42) for part in parts for w in part), "u8", len(words)).view("i8")

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word, and whether the word is there: two words of one hash would leave the second unfound."""
        if not len(self.hashes):
            return np.zeros(len(words), "i8"), np.zeros(len(words), bool)
        place = np.minimum(np.searchsorted(self.hashes, self._hashes(words)), len(self.hashes) - 1)
        if self.order is not None:
            place = self.order[place]
        return place, pc.equal(self.words.take(pa.array(place)), words).to_numpy(zero_copy_only=False)


_LOOKUPS: dict[int, Lookup] = {}


def _lookup_of(sent) -> Lookup:
    """The lookup of a table that was sent, made once per Python worker."""
    key = id(sent.value)
    if key not in _LOOKUPS:
        _LOOKUPS.clear()
        _LOOKUPS[key] = Lookup(sent.value)
    return _LOOKUPS[key]


def drop_lookups() -> None:
    """Drop the table that this Python worker holds; workers outlive a query."""
    _LOOKUPS.clear()


def _one(values: pa.Array) -> pa.ListArray:
    """All values as the list of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers with their lowest bytes first, then the next ones, and so on, which compresses better."""
    return numbers.astype("<u4").view("u1").reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes | pa.Buffer) -> np.ndarray:
    return np.frombuffer(planes, "u1").reshape(4, -1).T.copy().view("<u4").ravel()


def _portions(ends: np.ndarray, words: int) -> list[int]:
    """Bounds of the texts of a bundle (``ends``: words up to each one's end) in portions of about ``words`` words."""
    if not len(ends):
        return [0, 0]
    return [0, *(np.flatnonzero(np.diff(ends // words)) + 1).tolist(), len(ends)]


def _bundles(docs: DataFrame, keep: Sequence[str], pattern: str, bundle_words: int) -> DataFrame:
    """One row per bundle: ``docs`` (kept columns), ``sizes`` (words of each text), ``codes`` (the number of every word in
    a row, both as ``_planes``), ``words`` by number and ``counts``, how often each occurs."""

    def bundle(held: list[pa.RecordBatch], lists: list[np.ndarray], seen: dict[str, int]) -> pa.RecordBatch:
        codes = np.concatenate(lists)
        sizes = np.fromiter(map(len, lists), "i4", len(lists))
        rows = pa.StructArray.from_arrays(
            [pa.concat_arrays([batch[at] for batch in held]) for at in range(len(keep))], names=list(names)
        )
        counts = pa.array(np.bincount(codes, minlength=len(seen)), pa.int64())
        columns = [_one(rows), pa.array([_planes(sizes)]), pa.array([_planes(codes)])]
        columns += [_one(pa.array(seen.keys(), pa.string())), _one(counts)]
        return pa.RecordBatch.from_arrays(columns, names=["docs", "sizes", "codes", "words", "counts"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_lookups()
        split = splitter(pattern)
        held, lists, seen, count = [], [], Numbers(), 0
        for batch in batches:
            start = 0
            for at, text in enumerate(batch["_text"].to_pylist()):
                words = split(text)
                lists.append(np.fromiter(map(seen.__getitem__, words), "i4", len(words)))
                count += len(words)
                if count >= bundle_words:
                    held.append(batch.slice(start, at + 1 - start))
                    yield bundle(held, lists, seen)
                    held, lists, seen, count, start = [], [], Numbers(), 0, at + 1
            if start < len(batch):
                held.append(batch.slice(start))
        if lists:
            yield bundle(held, lists, seen)

    # Names of the bundle's own, since kept columns may have any.
    names = [f"c{at}" for at in range(len(keep))]
    fields = [T.StructField(name, docs.schema[column].dataType) for name, column in zip(names, keep)]
    schema = T.StructType(
        [
            T.StructField("docs", T.ArrayType(T.StructType(fields))),
            T.StructField("sizes", T.BinaryType()),
            T.StructField("codes", T.BinaryType()),
            T.StructField("words", T.ArrayType(T.StringType())),
            T.StructField("counts", T.ArrayType(T.LongType())),
        ]
    )
    return docs.mapInArrow(gather, schema)


def _looked_up(bundles: DataFrame, known: pa.Table, ranks: Ranks) -> DataFrame:
    """Bundles with ``places`` (of their words: those that have ids by now first, then the others), ``sizes_known`` and
    ``known`` (number of ids of the former, and the ids), and ``words``, which are the others alone."""
    sent = bundles.sparkSession.sparkContext.broadcast(known)  # bounded by TABLE_WORDS words of LONG_WORD bytes
    path, pattern, table = ranks.path, ranks.pattern, None

    def library(words: Sequence[str]) -> list[list[int]]:
        import tiktoken

        nonlocal table
        if table is None:
            table = tiktoken.Encoding(
                "own", pat_str=pattern, mergeable_ranks=Ranks(path, pattern).table, special_tokens={}
            )
        return [table.encode_ordinary(w) for w in words]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _lookup_of(sent)
        for batch in batches:
            for at in range(len(batch)):
                words = batch["words"][at].values
                place, found = lookup(words)
                long = pc.greater(pc.binary_length(words), LONG_WORD).to_numpy(zero_copy_only=False)
                there = found | long
                order = np.concatenate([np.flatnonzero(part) for part in (found, long, ~there)])  # none long is in the table
                places = np.empty(len(words), "i4")
                places[order] = np.arange(len(words), dtype="i4")
                ids = lookup.ids.take(pa.array(place[found])).cast(pa.list_(pa.int32()))
                if long.any():
                    made = library(words.filter(pa.array(long)).to_pylist())
                    ids = pa.concat_arrays([ids, pa.array(made, pa.list_(pa.int32()))])
                sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
                made = [places, sizes, ids.flatten().to_numpy()]
                columns = [batch[name].slice(at, 1) for name in ("docs", "sizes", "codes")]
                columns += [pa.array([numbers.astype("<i4").tobytes()], pa.binary()) for numbers in made]
                columns.append(_one(words.filter(pa.array(~there))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    given = bundles.schema
    fields = [given["docs"], given["sizes"], given["codes"]]
    fields += [T.StructField(name, T.BinaryType()) for name in ("places", "sizes_known", "known")]
    schema = T.StructType([*fields, given["words"]])
    return bundles.select("docs", "sizes", "codes", "words").mapInArrow(look_up, schema)


def _slices(joined: bytes, sizes: np.ndarray) -> list[bytes]:
    """Parts of the given sizes in a row."""
    ends = np.cumsum(sizes).tolist()
    return [joined[start:end] for start, end in zip([0, *ends], ends)]


def _texts(bundles: DataFrame, keep: Sequence[T.StructField], ranks: Ranks, forms: Sequence[str]) -> DataFrame:
    """One row per text of the bundles: the kept columns and the ``forms`` of its ids, words put in a row by number."""
    pieces = [b""] * (max(ranks.table.values(), default=-1) + 1)
    for token, rank in ranks.table.items():
        pieces[rank] = token
    sent = bundles.sparkSession.sparkContext.broadcast(pieces)
    kinds = {"ids": T.ArrayType(T.IntegerType()), "packed": T.BinaryType(), "decoded": T.BinaryType()}

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = sent.value
        for batch in batches:
            for at in range(len(batch)):
                row = {name: batch[name][at] for name in batch.schema.names}
                known, places, sizes = (np.frombuffer(row[n].as_buffer(), "<i4") for n in ("known", "places", "sizes_known"))
                rest = row["rest"].values
                ids = np.concatenate([known, rest.flatten().to_numpy().astype("<i4")])
                sizes = np.concatenate([sizes, pc.list_value_length(rest).to_numpy(zero_copy_only=False)])
                of_words = {}  # what each word gives, by place
                for form in forms:
                    if form == "decoded":
                        tokens = list(map(spelled.__getitem__, ids.tolist()))
                        bounds = np.cumsum([0, *map(len, tokens)])[np.cumsum([0, *sizes])]
                        of_words[form] = _slices(b"".join(tokens), np.diff(bounds))
                    else:
                        of_words[form] = _slices(ids.tobytes(), 4 * sizes.astype("i8"))
                codes, ends = _numbers(row["codes"].as_buffer()), np.cumsum(_numbers(row["sizes"].as_buffer()), dtype="i8")
                docs = row["docs"].values
                bounds = _portions(ends, PORTION_WORDS)
                for begin, end in zip(bounds, bounds[1:]):
                    stops = [int(ends[begin - 1]) if begin else 0, *ends[begin:end].tolist()]
                    columns = docs.slice(begin, end - begin).flatten()
                    for form in forms:
                        word = of_words[form].__getitem__
                        made = [b"".join(map(word, places[codes[a:z]].tolist())) for a, z in zip(stops, stops[1:])]
                        if form == "ids":
                            offsets = np.cumsum([0, *map(len, made)]) // 4
                            values = pa.array(np.frombuffer(b"".join(made), "<i4"), pa.int32())
                            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values))
                        else:
                            columns.append(pa.array(made, pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    schema = T.StructType([*keep, *(T.StructField(form, kinds[form]) for form in forms)])
    return bundles.mapInArrow(put, schema)


def encode(
    docs: DataFrame,
    ranks: Ranks,
    column: str = "text",
    keep: Sequence[str] = ("doc_id",),
    forms: Sequence[str] = ("ids",),
    table_words: int = TABLE_WORDS,
    bundle_words: int = BUNDLE_WORDS,
) -> DataFrame:
    """The kept columns of every row with the ids of its whole text, one row for one row.

    ``forms`` names what to give: ``ids`` as a list, ``packed`` as little-endian unsigned 32-bit integers, ``decoded``
    as the bytes that the ids stand for. Each is made per distinct word of a bundle and put in a row per text.

    Ids are those of the tiktoken library without special tokens. A null or empty text has no ids; rows with equal
    ids, equal texts or null ids stay rows of their own; an empty table gives an empty one. Columns outside ``keep``
    are not carried, so their names are free. A word (match of the pattern) above ``LONG_WORD`` bytes goes to the
    library itself, since the fold takes time with the square of a word's length.

    ``table_words`` bounds the table sent to tasks, ``bundle_words`` the words of a bundle; a text with more is one
    bundle. Neither changes a result. Every bundle is a row group of its own, so that a task reads one at once.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "bundles")
    made = _bundles(docs.select(*keep, F.col(column).cast("string").alias("_text")), keep, ranks.pattern, bundle_words)
    # By size alone a row group would end at 100 bundles at the earliest, when the writer first looks at it.
    made.write.option("compression", "zstd").option("parquet.block.row.count.limit", 1).parquet(path)
    bundles = spark.read.schema(made.schema).parquet(path)
    known = frequent_words(bundles, ranks, table_words).toArrow()
    known = known.set_column(0, "word", known["word"].cast(pa.string())).combine_chunks()  # one piece, for ``Lookup``
    rest = _let(_rank_map(ranks), lambda table: F.transform(F.col("words"), lambda word: merged(table, word)))
    whole = _looked_up(bundles, known, ranks).withColumn("rest", rest).drop("words")
    return _texts(whole, [docs.schema[name] for name in keep], ranks, forms)


def decode(ids: Column, ranks: Ranks) -> Column:
    """Bytes of a list of ids: its tokens' bytes in a row. An id without a token is passed over; null stays null."""
    pieces = F.from_json(F.lit(ranks.pieces), "array<string>")
    return _let(pieces, lambda table: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")))


def little_endian(ids: Column, ranks: Ranks) -> Column:
    """A list of ids as little-endian unsigned 32-bit integers."""
    packed = F.from_json(F.lit(ranks.packed), "array<string>")
    return _let(packed, lambda table: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")))


def digests(docs: DataFrame, ranks: Ranks) -> DataFrame:
    """``doc_id`` with the number of ids of the text, and the SHA-256 of the ids and of the bytes they decode to."""
    encoded = encode(docs, ranks, forms=("packed", "decoded"))
    return encoded.select(
        "doc_id",
        F.expr("octet_length(packed) div 4").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
