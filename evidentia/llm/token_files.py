"""Token ids in files of directly addressable codes.

An id is split into chunks of 8 bits, low chunk first. Level 0 holds the low
chunk of every id and a bitmap that says which ids go on; level 1 holds the
next chunk of those alone, with its own bitmap, and so on. The position of an
id in the next level is the rank of its bit, and a directory with the rank at
every 512th bit makes that a short count, so any token can be read without
decoding others. Common (small) ids take nine bits.

Files are Parquet rows written by Spark to a shared folder: one row per segment
with the ids of whole documents. Documents are dealt to tasks by ranges of
doc_id, so shards in order are documents in order; offsets come from sums by
shard, and only those (one number per task) pass the driver.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from evidentia.llm.common import shared_folder

_MAGIC = b"DAC1"
_STEP = 512
#: Cached words and pre-tokens, and the length of a cached word.
_KEEP, _KEEP_PARTS, _LONGEST = 400_000, 1_000_000, 48
#: A segment is closed after the document that fills it.
SEGMENT_TOKENS = 1 << 20


def pack(ids: np.ndarray) -> bytes:
    """Unsigned 32-bit ids as chunk levels, each with bitmap and rank directory (none on the last)."""
    parts, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        final = not more.any()
        bits = b"" if final else np.packbits(more, bitorder="little").tobytes()
        steps = b"" if final else np.r_[0, np.add.reduceat(more, np.arange(0, len(more), _STEP))].cumsum().astype("<u8").tobytes()
        chunks = rest.astype(np.uint8).tobytes()
        parts.append(struct.pack("<QQQ", len(chunks), len(bits), len(steps)) + chunks + bits + steps)
        if final:
            return _MAGIC + struct.pack("<B", len(parts)) + b"".join(parts)
        rest = rest[more] >> np.uint32(8)


class Codes:
    """Random access to packed ids."""

    def __init__(self, payload: bytes):
        if payload[:4] != _MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.levels, at = [], 5
        for _ in range(payload[4]):
            sizes = struct.unpack_from("<QQQ", payload, at)
            at += 24
            views = []
            for size, kind in zip(sizes, ("u1", "u1", "<u8")):
                views.append(np.frombuffer(payload, kind, size // np.dtype(kind).itemsize, at))
                at += size
            self.levels.append(views)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, position: int) -> int:
        """Ids before ``position`` that go on to the next level."""
        _, bits, steps = self.levels[level]
        block = position // _STEP
        whole, rest = divmod(position, 8)
        first = block * _STEP // 8
        count = int(steps[block]) + int(np.bitwise_count(bits[first:whole]).sum(dtype=np.int64))
        return count + (int(bits[whole] & ((1 << rest) - 1)).bit_count() if rest else 0)

    def get(self, position: int) -> int:
        """One id, from as many chunks as it has."""
        if not 0 <= position < len(self):
            raise IndexError(position)
        value = shift = level = 0
        while True:
            chunks, bits, _ = self.levels[level]
            value |= int(chunks[position]) << shift
            if not len(bits) or not bits[position // 8] >> (position % 8) & 1:
                return value
            position, level, shift = self._rank(level, position), level + 1, shift + 8

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop``: a slice of each level, found by rank."""
        return self._slice(0, start, stop)

    def _slice(self, level: int, start: int, stop: int) -> np.ndarray:
        chunks, bits, _ = self.levels[level]
        out = chunks[start:stop].astype(np.uint32)
        if len(bits) and stop > start:
            base = start // 8 * 8
            more = np.unpackbits(bits[start // 8 : (stop + 7) // 8], bitorder="little")[start - base : stop - base].astype(bool)
            if more.any():
                first = self._rank(level, start)
                out[more] |= self._slice(level + 1, first, first + int(more.sum())) << np.uint32(8)
        return out


#: The vocabulary's own rule for pre-tokens, over characters that
#: its normaliser only turns to lower case; words with others go in whole.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PLAIN_TEXT = re.compile("[ -~\t\n\rÀ-ÖØ-öø-ÿ]*")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ÿ]+|[0-9]|[^a-z0-9À-ÖØ-öø-ÿ]+")
_WORD_END = "</w>"
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
#: Kind of each byte of a plain lower-case text; its only bytes beyond ASCII are those of Latin letters.
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[list(b" \t\n\r")] = _SPACE
_KINDS[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = _LETTER
_KINDS[list(b"0123456789")] = _DIGIT
#: Bytes of plain texts that are cut at a time.
_AT_ONCE = 8 << 20


def part_ends(data: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of plain lower-case bytes end, white space in front of each going with it.

    A run of letters or of other characters is a pre-token, as is every digit.
    An apostrophe that begins a run of others takes a short ending with it.
    """
    kind = np.append(_KINDS[data], _SPACE)
    before = kind[:-1]
    ends = (before != _SPACE) & ((before != kind[1:]) | (before == _DIGIT))
    marks = np.flatnonzero(data == ord("'"))
    marks = marks[(marks == 0) | (before[marks - 1] != _OTHER)]
    padded = np.append(data, [0, 0])
    first, second = padded[marks + 1], padded[marks + 2]
    one = np.isin(first, list(b"stmd"))
    two = ((second == ord("e")) & np.isin(first, list(b"rv"))) | ((first == ord("l")) & (second == ord("l")))
    ends[marks[one | two]] = False
    ends[marks[one] + 1] = True
    ends[marks[two] + 2] = True
    return np.flatnonzero(ends) + 1


class WordTokenizer:
    """The ids of a text by its pre-tokens, which the library encodes apart from each other.

    Plain texts are cut together, as one array of bytes; the library encodes
    each distinct pre-token that is new, many at a time, and ids are gathered
    by dictionary index. Other texts go by words, as the pre-tokenizer never
    joins across white space; words are cached.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for name, i in vocabulary.items() if name.endswith(_WORD_END)]] = True
        self._parts: dict[str, bytes] = {}
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of pre-tokens, encoded as one text and cut behind each end of a word."""
        ids = np.array(self.model.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(cuts) != len(parts):
            return self._encode(parts)
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip([0, *cuts], cuts)]

    def batch(self, texts: list[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null is empty."""
        group: list[str] = []
        size, plain = 0, True
        for text in texts:
            text = text or ""
            kind = _PLAIN_TEXT.fullmatch(text) is not None and "<|" not in text
            if group and (kind != plain or size > _AT_ONCE):
                yield from self._plain(group) if plain else self._words(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
            plain = kind
        if group:
            yield from self._plain(group) if plain else self._words(group)

    def _plain(self, texts: list[str]) -> Iterator[bytes]:
        raw = [text.lower().encode() + b"\n" for text in texts]
        data = b"".join(raw)
        ends = part_ends(np.frombuffer(data, np.uint8))
        offsets = pa.py_buffer(np.append(0, ends).astype(np.int64))
        parts = pa.LargeStringArray.from_buffers(len(ends), offsets, pa.py_buffer(data)).dictionary_encode()
        distinct = [p.lstrip(" \t\n\r") for p in parts.dictionary.to_pylist()]
        known = self._parts
        if len(known) >= _KEEP_PARTS:
            known.clear()
        missing = list({p for p in distinct if p not in known})
        for at in range(0, len(missing), 20_000):
            some = missing[at : at + 20_000]
            known.update(zip(some, self._encode_parts(some)))
        ids = [known[p] for p in distinct]
        for part in missing:
            if len(part) > _LONGEST:
                del known[part]
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(counts) - counts
        index = parts.indices.to_numpy()
        width = counts[index]
        done = np.append(0, np.cumsum(width))
        places = np.repeat(first[index] - done[:-1], width) + np.arange(done[-1])
        tokens = np.frombuffer(b"".join(ids), "<u4")[places]
        stops = done[np.searchsorted(ends, np.cumsum([len(r) for r in raw]), "right")].tolist()
        for start, stop in zip([0, *stops], stops):
            yield tokens[start:stop].tobytes()

    def _words(self, texts: list[str]) -> Iterator[bytes]:
        group: list[list[str]] = []
        size = 0
        for text in texts:
            # Python also splits at these four, the library does not
            words = [text] if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
            group.append(words)
            size += len(words)
            if size > 300_000:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, group: list[list[str]]) -> Iterator[bytes]:
        if len(self._new) >= _KEEP:
            self._old, self._new = self._new, {}
        new, old = self._new, self._old
        fresh = []
        for word in [w for w in set().union(*group) if w not in new]:
            got = old.get(word)
            if got is None:
                fresh.append(word)
            else:
                new[word] = got
        self._learn(fresh)
        for words in group:
            yield b"".join(map(new.__getitem__, words))
        for word in fresh:
            if len(word) > _LONGEST:
                del new[word]

    def _learn(self, words: list[str]) -> None:
        cut, whole = [], []
        for word in words:
            if _PLAIN.fullmatch(word) and "<|" not in word:
                cut.append((word, _PARTS.findall(word.lower())))
            else:
                whole.append(word)
        self._new.update(zip(whole, self._encode(whole)))
        known = self._parts
        if len(known) >= _KEEP_PARTS:
            known.clear()
        missing = list({p for _, parts in cut for p in parts if p not in known})
        for at in range(0, len(missing), 20_000):
            some = missing[at : at + 20_000]
            known.update(zip(some, self._encode_parts(some)))
        for word, parts in cut:
            self._new[word] = known[parts[0]] if len(parts) == 1 else b"".join([known[p] for p in parts])


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _segments(path: str, end_id: int, key_type: pa.DataType, segment_tokens: int):
    """Rows of segments from sorted (doc_id, shard, text)."""
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = WordTokenizer(path)
        keys: list = []
        sizes: list[int] = []
        held: list[bytes] = []
        number, shard = 0, None

        def row():
            ids = np.frombuffer(b"".join(held), "<u4")
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([keys], pa.list_(key_type)),
                    pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([pack(ids)], pa.binary()),
                ],
                ["shard", "segment", "n_tokens", "doc_ids", "doc_tokens", "payload"],
            )

        total = 0
        for batch in batches:
            if batch.num_rows:
                shard = batch["shard"][0].as_py()
            for key, ids in zip(batch["doc_id"].to_pylist(), _TOKENIZERS[path].batch(batch["text"].to_pylist())):
                keys.append(key)
                held.append(ids + end)
                sizes.append(len(ids) // 4 + 1)
                total += sizes[-1]
                if total >= segment_tokens:
                    yield row()
                    keys, sizes, held, total, number = [], [], [], 0, number + 1
        if keys:
            yield row()

    return write


def write_files(docs: DataFrame, path: str, end_id: int = 1, folder: str | None = None, segment_tokens: int = SEGMENT_TOKENS) -> str:
    """Write the ids of (doc_id, text) in ascending doc_id order; the folder written.

    Null text: the end id alone. Null doc_ids come first. Rows with one doc_id
    stay apart, in the order of their texts. Further columns are not written.
    An empty table gives a folder without segments.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    rows = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = rows.withColumn("shard", F.spark_partition_id())
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"shard int, segment int, n_tokens long, doc_ids array<{key}>, doc_tokens array<int>, payload binary"
    from pyspark.sql.pandas.types import to_arrow_type

    write = _segments(path, end_id, to_arrow_type(docs.schema["doc_id"].dataType), segment_tokens)
    rows.mapInArrow(write, schema).write.option("compression", "zstd").parquet(folder)
    return folder


def segment_starts(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, segment, first): ids in all files before each segment."""
    sizes = spark.read.parquet(folder).select("shard", "segment", "n_tokens")
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()  # one row per task
    before, at = [], 0
    for s in shards:
        before.append((s["shard"], at))
        at += s["n"]
    bases = spark.createDataFrame(before, "shard int, base long")
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return sizes.join(bases, "shard").select("shard", "segment", (F.col("base") + F.col("inside")).alias("first"))


def read_documents(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids array<int>) from the files."""
    files = spark.read.parquet(folder)
    key = files.schema["doc_ids"].dataType.elementType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, at = Codes(row["payload"]), 0
                starts, sums, values = [], [], []
                for size in row["doc_tokens"]:
                    got = codes.read(at, at + size)
                    starts.append(at)
                    sums.append(zlib.crc32(got.astype("<u4").tobytes()))
                    values.append(got.astype(np.int32) if ids else None)
                    at += size
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * n, pa.int32()),
                        pa.array([row["segment"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], batch["doc_ids"].type.value_type),
                        pa.array(starts, pa.int64()),
                        pa.array(row["doc_tokens"], pa.int64()),
                        pa.array(sums, pa.int64()),
                        pa.array(values, pa.list_(pa.int32())),
                    ],
                    ["shard", "segment", "doc_id", "inside", "n_tokens", "ids_crc32", "ids"],
                )

    schema = f"shard int, segment int, doc_id {key}, inside long, n_tokens long, ids_crc32 long, ids array<int>"
    rows = files.mapInArrow(read, schema)
    rows = rows if ids else rows.drop("ids")
    rows = rows.join(segment_starts(spark, folder), ["shard", "segment"])
    rest = ["n_tokens", "ids_crc32", *(["ids"] if ids else [])]
    return rows.select("doc_id", (F.col("first") + F.col("inside")).alias("start"), *rest)


def tokens_at(spark: SparkSession, folder: str, positions: DataFrame) -> DataFrame:
    """(position, id) of single tokens; positions outside the files have no row.

    Positions are dealt to the segment that holds them by shard ranges of the
    small table of segments, and each is read alone.
    """
    starts = segment_starts(spark, folder)
    sizes = spark.read.parquet(folder).select("shard", "segment", "n_tokens")
    spans = starts.join(sizes, ["shard", "segment"])
    # as-of: positions and segment starts in one order; the last start at or before a position holds it
    width = F.lit(SEGMENT_TOKENS)
    spans = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("first") / width), F.floor((F.col("first") + F.col("n_tokens") - 1) / width))))
    wanted = positions.select("position", F.floor(F.col("position") / width).alias("cell"))
    held = wanted.join(spans, "cell").where("position >= first and position < first + n_tokens")
    held = held.groupBy("shard", "segment").agg(F.collect_set(F.col("position") - F.col("first")).alias("at"), F.first("first").alias("first"))
    rows = spark.read.parquet(folder).select("shard", "segment", "payload").join(held, ["shard", "segment"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["payload"])
                yield pa.RecordBatch.from_pydict(
                    {"position": pa.array([row["first"] + a for a in row["at"]], pa.int64()), "id": pa.array([codes.get(a) for a in row["at"]], pa.int64())}
                )

    return rows.mapInArrow(read, "position long, id long")
