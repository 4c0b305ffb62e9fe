"""Removal of repeated passages with sparse suffixes and a distributed merge sort.

A byte goes if a string of ``window`` bytes that covers it also starts earlier
(smaller doc_id, or earlier in the same document). Sorting every suffix is not
needed to find out: of the grams in a window the one with the smallest hash is
its *anchor*, so equal windows have anchors at the same place, and each window
belongs to one anchor. The suffixes at anchors are sorted, each with the bytes
before it that its windows need.

1. Copies of whole texts go by their digest; they need no sorting.
2. Anchors whose gram occurs once can't repeat and are dropped: hashes are
   counted, pre-aggregated, those that occur twice put into a broadcast bitmap
   of bounded size, and the texts read again. An anchor that passes by chance
   meets no equal one.
3. Each task sorts its suffixes into runs, front-coded (length of the prefix
   shared with the one before, then the rest), and exchanges them by gram.
   Equal suffixes of a run go as one.
4. Runs are merged by a loser tree that keeps, for each contender, the length
   of its prefix shared with the last winner: the longer one wins unseen, and
   only equal lengths are compared, from that byte on.
5. Suffixes equal to an earlier one repeat in all their windows. Those that
   share only the gram are compared window by window, by offset, with rolling
   hashes of 64 bits.
6. Grams with more than ``hot`` anchors would fill a task; their windows are
   counted by hash in Spark instead (pre-aggregated), with the same result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from evidentia.llm.common import stored

_BLOCK = 1 << 20
_ODD = np.random.default_rng(17).integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
_BYTES = np.random.default_rng(18).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Repeats:
    """Bytes of a repeated string and of a gram (a power of two), and anchors of a gram that one task may merge."""

    window: int = 100
    gram: int = 32
    hot: int = 100_000

    @property
    def reach(self) -> int:
        """Bytes that may lie before an anchor in its window."""
        return self.window - self.gram


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[14]
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the gram at each position, by doubling."""
    hashes, size = _BYTES[data], 1
    while size < gram:
        hashes = _mixed(hashes[:-size] * _ODD[size.bit_length()] + hashes[size:])
        size *= 2
    return hashes


def anchors(data: np.ndarray, how: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, first window, last window, gram hash) of the anchors of a text; every window is in one row."""
    out = []
    for base in range(0, max(0, len(data) - how.window + 1), _BLOCK - how.window):
        block = data[base : base + _BLOCK - 1]
        if len(block) < how.window:
            break
        hashes = gram_hashes(block, how.gram)
        place = np.uint64(_BLOCK - 1)
        least = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
        size, width = 1, how.reach + 1
        while size * 2 <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < width:
            least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
        at = (least & place).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:] - 1, len(at) - 1]
        out.append((at[first] + base, first + base, last + base, hashes[at[first]].view(np.int64)))
    if not out:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out))


# -- front-coded runs and their merge -------------------------------------------------


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    most = min(len(a), len(b))
    differ = int.from_bytes(a[known:most], "big") ^ int.from_bytes(b[known:most], "big")
    return most - (differ.bit_length() + 7) // 8


_HEAD = "<BHqiii"


def front_code(rows: list[tuple[bytes, int, int, int, int]]) -> bytes:
    """Sorted (suffix, doc, position, first, last) with distinct suffixes as one run."""
    out, before = [], b""
    for suffix, *where in rows:
        shared = shared_prefix(before, suffix, 0)
        out.append(struct.pack(_HEAD, shared, len(suffix) - shared, *where))
        out.append(suffix[shared:])
        before = suffix
    return b"".join(out)


def run_of(data: bytes) -> Iterator[tuple[int, bytes, tuple[int, int, int, int]]]:
    """(prefix shared with the one before, suffix, (doc, position, first, last))."""
    at, before, size = 0, b"", struct.calcsize(_HEAD)
    while at < len(data):
        shared, rest, *where = struct.unpack_from(_HEAD, data, at)
        at += size
        before = before[:shared] + data[at : at + rest]
        at += rest
        yield shared, before, tuple(where)


def merged(runs: list[bytes]) -> Iterator[tuple[int, bytes, tuple[int, int, int, int]]]:
    """All runs in order, each with the prefix it shares with the one before it (-1 for the first).

    A loser tree: inner nodes hold the loser of their match. Every contender
    knows its shared prefix with the last winner.
    """
    count = max(1, len(runs))
    sources = [run_of(r) for r in runs]
    current = [next(s, None) for s in sources] + [None] * (count - len(runs))
    known = [0] * count
    tree = [-1] * count

    def play(run: int, node: int) -> int:
        """Match ``run`` against the losers on its way up; the winner."""
        while node:
            other = tree[node]
            if other < 0:
                tree[node] = run
                return -1
            if current[other] is not None:
                wins = current[run] is not None
                if wins:
                    if known[run] == known[other]:
                        a, b = current[run][1], current[other][1]
                        same = shared_prefix(a, b, known[run])
                        wins = a[same:] <= b[same:]
                        known[other if wins else run] = same
                    else:
                        wins = known[run] > known[other]
                if not wins:
                    tree[node], run = run, other
            node //= 2
        return run

    winner = -1
    for run in range(count):
        winner = play(run, (run + count) // 2)
    same = -1
    while winner >= 0 and current[winner] is not None:
        _, suffix, where = current[winner]
        yield same, suffix, where
        current[winner] = next(sources[winner], None)
        if current[winner] is not None:
            known[winner] = current[winner][0]
        winner = play(winner, (winner + count) // 2)
        if current[winner] is not None:
            same = known[winner]


# -- windows that repeat in part ---------------------------------------------------------


def repeated_windows(suffixes: list[bytes], where: np.ndarray, how: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """(row, window start) of the windows that an earlier row also holds at the same offset.

    ``where`` has (doc, position, first, last) by row; suffixes are as in
    :func:`suffix_of`. Offsets are taken in turn and the hash rolls with them.
    """
    order = np.lexsort((where[:, 1], where[:, 0]))
    where = where[order]
    before, after = how.reach, how.window
    text = np.zeros((len(order), before + after), np.uint8)
    for row, i in enumerate(order.tolist()):
        suffix = suffixes[i]
        right = suffix[-1]
        text[row, before : before + right] = np.frombuffer(suffix, np.uint8, right)
        left = np.frombuffer(suffix, np.uint8, len(suffix) - 1 - right, right)
        text[row, before - len(left) : before] = left[::-1]
    step = _ODD[0]
    drop = np.uint64(pow(int(step), how.window - 1, 1 << 64))
    rolled = np.zeros(len(order), np.uint64)
    for j in range(how.window):
        rolled += _BYTES[text[:, before + j]] * np.uint64(pow(int(step), j, 1 << 64))
    rows, starts = [], []
    for offset in range(how.reach + 1):
        if offset:
            out = _BYTES[text[:, before + after - offset]]
            rolled = (rolled - out * drop) * step + _BYTES[text[:, before - offset]]
        start = where[:, 1] - offset
        own = np.flatnonzero((start >= where[:, 2]) & (start <= where[:, 3]))
        if len(own) > 1:
            _, first, inverse = np.unique(rolled[own], return_index=True, return_inverse=True)
            late = np.flatnonzero(first[inverse] != np.arange(len(own)))
            rows.append(order[own[late]])
            starts.append(start[own[late]])
    none = np.empty(0, np.int64)
    return (np.concatenate(rows), np.concatenate(starts)) if rows else (none, none)


def suffix_of(data: bytes, at: int, first: int, last: int, window: int) -> bytes:
    """The bytes from the anchor to the end of its last window, those before it in reverse, and the length of the former."""
    right = data[at : last + window]
    return right + data[first:at][::-1] + bytes([len(right)])


def intervals(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint, sorted intervals of a union; touching ones are joined."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]]) if len(starts) else np.empty(0, np.int64)
    return starts[new], reach[np.r_[new[1:] - 1, len(reach) - 1]] if len(starts) else reach


# -- Spark ------------------------------------------------------------------------------


#: Bits of a bitmap for each key, and in all.
_BITS_A_KEY, _MOST_BITS = 16, 1 << 29


class Bitmap:
    """A broadcast bitmap of 64-bit hashes: what it lacks was surely not put in.

    Sixteen bits a key up to 64 MB; beyond that more hashes share a bit, which
    costs work but no result.
    """

    def __init__(self, keys: DataFrame, name: str):
        spark = keys.sparkSession
        self.size = min(_MOST_BITS, 1 << max(16, (keys.count() * _BITS_A_KEY - 1).bit_length()))
        size, slices = self.size, 64
        width = size // slices

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                spots = batch["spot"].to_numpy()
                for part in np.unique(spots // width).tolist():
                    held.setdefault(part, np.zeros(width, bool))[spots[spots // width == part] % width] = True
            packed = [np.packbits(bits, bitorder="little").tobytes() for bits in held.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(packed, pa.binary())], ["part", "bits"])

        spots = keys.select(F.col(name).bitwiseAND(F.lit(size - 1)).alias("spot")).withColumn("part", F.floor(F.col("spot") / width))
        bits = np.zeros(size // 8, np.uint8)
        for row in spots.repartition(slices, "part").select("spot").mapInArrow(build, "part int, bits binary").collect():  # 64 MB at most
            bits[row["part"] * (width // 8) : (row["part"] + 1) * (width // 8)] = np.frombuffer(row["bits"], np.uint8)
        self.shared = spark.sparkContext.broadcast(bits)

    def test(self):
        """A function for tasks: which of an array of hashes may have been put in."""
        shared, mask = self.shared, self.size - 1

        def held(hashes: np.ndarray) -> np.ndarray:
            spots = hashes & mask
            return (shared.value[spots >> 3] >> (spots & 7).astype(np.uint8) & 1).astype(bool)

        return held

    def column(self, hashes):
        """The same for a column of hashes."""
        held = self.test()

        @F.arrow_udf("boolean")
        def looked_up(values: pa.Array) -> pa.Array:
            return pa.array(held(values.to_numpy(zero_copy_only=False).astype(np.int64)))

        return looked_up(hashes)


def _all_anchors(how: Repeats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].cast(pa.binary())
            for at in range(0, batch.num_rows, 500):
                hashes = [anchors(np.frombuffer(text, np.uint8), how)[3] for text in texts.slice(at, 500).to_pylist()]
                grams, times = np.unique(np.concatenate(hashes), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(times)], ["h", "times"])

    return run


_FOUND = "doc_id long, start int, stop int"
_RUNS = "part long, run binary, " + _FOUND


def _write_runs(how: Repeats, parts: int, held_twice, hot: np.ndarray):
    """Front-coded runs by part, and intervals decided within the task, of anchors that may repeat and are not hot."""
    schema = pa.schema(
        [("part", pa.int64()), ("run", pa.binary()), ("doc_id", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())]
    )

    def batch_of(**columns):
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
        )

    def runs(rows: list[list]) -> Iterator[pa.RecordBatch]:
        done, blobs, numbers = ([], [], []), [], []
        for part, own in enumerate(rows):
            if not own:
                continue
            own.sort()  # equal suffixes by document and position: the first stands for the run
            kept, before = [], None
            for row in own:
                if row[0] == before:
                    done[0].append(row[1])
                    done[1].append(row[3])
                    done[2].append(row[4] + how.window)
                else:
                    kept.append(row)
                    before = row[0]
            blobs.append(front_code(kept))
            numbers.append(part)
            own.clear()
        for i in range(0, len(blobs), 64):
            yield batch_of(part=numbers[i : i + 64], run=blobs[i : i + 64])
        if done[0]:
            yield batch_of(part=[d % parts for d in done[0]], doc_id=done[0], start=done[1], stop=done[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = [[] for _ in range(parts)]
        held = 0
        for batch in batches:
            for at in range(batch.num_rows):
                text = batch["text"][at].as_py().encode("utf-8", "surrogatepass")
                doc = batch["doc_id"][at].as_py()
                data = np.frombuffer(text, np.uint8)
                found = anchors(data, how)
                chosen = held_twice(found[3]) & ~np.isin(found[3], hot)
                for place, first, last, h in zip(*[x[chosen].tolist() for x in found]):
                    rows[h % parts].append((suffix_of(text, place, first, last, how.window), doc, place, first, last))
                    held += 1
                if held > 400_000:
                    yield from runs(rows)
                    held = 0
        yield from runs(rows)

    return run


def _hot_windows(how: Repeats, hot: np.ndarray):
    """Every window whose anchor's gram is hot, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = np.array([pow(int(_ODD[0]), j, 1 << 64) for j in range(how.window)], np.uint64)
        for batch in batches:
            for row in range(batch.num_rows):
                data = np.frombuffer(batch["text"][row].as_py().encode("utf-8", "surrogatepass"), np.uint8)
                found = anchors(data, how)
                chosen = np.isin(found[3], hot)
                views = np.lib.stride_tricks.sliding_window_view(data, how.window)
                for first, last in zip(*[x[chosen].tolist() for x in found[1:3]]):
                    hashes = (_BYTES[views[first : last + 1]] * powers).sum(1, dtype=np.uint64).view(np.int64)
                    starts = np.arange(first, last + 1, dtype=np.int32)
                    docs = np.full(len(starts), batch["doc_id"][row].as_py(), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(starts), pa.array(hashes)], ["doc_id", "start", "window_hash"])

    return run


def _merge_runs(how: Repeats):
    """Intervals that repeat, from all runs of a partition; other rows pass through."""

    def out(docs, starts, stops):
        return pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())], ["doc_id", "start", "stop"]
        )

    def partial(suffixes, where):
        where = np.array(where, np.int64).reshape(-1, 4)
        rows, starts = repeated_windows(suffixes, where, how)
        order = np.lexsort((starts, rows))
        rows, starts = rows[order], starts[order]
        # windows in a row become one interval
        new = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (starts[1:] != starts[:-1] + 1)]) if len(rows) else rows
        ends = np.r_[new[1:] - 1, len(rows) - 1] if len(rows) else rows
        return out(where[rows[new], 0], starts[new], starts[ends] + how.window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[bytes] = []
        for batch in batches:
            blobs += [r for r in batch["run"].to_pylist() if r is not None]
            rest = batch.filter(batch["run"].is_null())
            if rest.num_rows:
                yield rest.select(["doc_id", "start", "stop"])
        whole: tuple[list, list, list] = ([], [], [])
        suffixes: list[bytes] = []
        where: list[tuple] = []
        group: list[tuple] = []

        def close():
            """Move a gram's suffixes to the batch for comparison by window if there are several."""
            if len(group) > 1:
                suffixes.extend(s for s, _ in group)
                where.extend(w for _, w in group)
            group.clear()

        for same, suffix, place in merged(blobs):
            if group and same >= len(suffix) and len(group[-1][0]) == len(suffix):
                earlier = group[-1][1]
                if place[:2] < earlier[:2]:
                    group[-1] = suffix, place
                    place = earlier
                whole[0].append(place[0])
                whole[1].append(place[2])
                whole[2].append(place[3] + how.window)
                continue
            if same < how.gram:
                close()
                if len(suffixes) > 50_000:
                    yield partial(suffixes, where)
                    suffixes.clear(), where.clear()
            group.append((suffix, place))
            if len(whole[0]) > 50_000:
                yield out(*whole)
                whole[0].clear(), whole[1].clear(), whole[2].clear()
        close()
        yield partial(suffixes, where)
        yield out(*whole)

    return run


def repeated_intervals(docs: DataFrame, how: Repeats = Repeats(), parts: int | None = None) -> DataFrame:
    """(doc_id, start, stop): byte intervals of repeated windows, for unique doc_ids and texts without whole copies."""
    spark = docs.sparkSession
    parts = parts or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    long = docs.where(F.octet_length("text") >= how.window)
    counted = long.mapInArrow(_all_anchors(how), "h long, times long").groupBy("h").agg(F.sum("times").alias("df"))
    frequent = stored(counted.where("df > 1"))
    hottest = np.array([r["h"] for r in frequent.where(F.col("df") > how.hot).select("h").collect()], np.int64)  # one in hot anchors at most
    runs = long.mapInArrow(_write_runs(how, parts, Bitmap(frequent, "h").test(), hottest), _RUNS)
    found = runs.repartition(parts, "part").mapInArrow(_merge_runs(how), _FOUND)
    if not len(hottest):
        return found
    hot = long.mapInArrow(_hot_windows(how, hottest), "doc_id long, start int, window_hash long")
    first = hot.groupBy("window_hash").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "start")).alias("f")).where("n > 1")
    late = hot.join(first, "window_hash").where((F.col("f.doc_id") != F.col("doc_id")) | (F.col("f.start") != F.col("start")))
    return found.unionByName(late.select("doc_id", "start", (F.col("start") + how.window).alias("stop")))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            rows = batch.slice(at, 500)
            kept, removed, spans, sizes = [], [], [], []
            for text, starts, stops in zip(*[rows[c].to_pylist() for c in ("text", "starts", "stops")]):
                data = (text or "").encode("utf-8", "surrogatepass")
                a, b = intervals(np.array(starts or [], np.int64), np.array(stops or [], np.int64))
                left = [0, *b.tolist()]
                kept.append(b"".join(data[x:y] for x, y in zip(left, [*a.tolist(), len(data)])))
                removed.append(int((b - a).sum()))
                spans.append(len(a))
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )


def without_repeats(docs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """For each row of (doc_id, text): doc_id, n_bytes, n_removed, n_spans and kept (the bytes left).

    Null and empty texts and texts shorter than a window stay whole. A copy of
    a text of a smaller doc_id goes whole. Rows without doc_id are returned
    unchanged and compared with nothing. If an id repeats, its text with the
    smallest digest takes part and its equal rows share the result; rows of
    the id with other texts are returned unchanged. Empty tables give an empty
    result, further columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    addressed = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    long_text = (F.octet_length("text") >= how.window) & F.col("doc_id").isNotNull()
    long = long_text & F.col("digest").isNotNull()
    narrow = stored(addressed.where(long).select("doc_id", "digest"))
    own = narrow.groupBy("doc_id").agg(F.min("digest").alias("digest"), F.count("*").alias("times"))
    first = own.groupBy("digest").agg(F.min("doc_id").alias("first"))
    own = stored(own.join(first, "digest"))
    copies = own.where("doc_id <> first").select("doc_id", "digest", F.lit(True).alias("copy"))
    # Texts that are no copy and whose id is unique take part as they are read; only the others move, to be settled exactly.
    maybe = Bitmap(own.where("times > 1 or doc_id <> first").select(F.xxhash64("doc_id").alias("h")), "h")
    texts = addressed.where(long)
    apart = maybe.column(F.xxhash64("doc_id"))
    sources = own.where("doc_id = first").select("doc_id", F.col("digest").alias("wanted"))
    settled = texts.where(apart).join(sources, "doc_id").where("digest = wanted").select("doc_id", "text").dropDuplicates(["doc_id"])
    source = rows.where(long_text).where(~apart).unionByName(settled)
    found = repeated_intervals(source, how)
    found = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("i"))
    found = found.join(own.select("doc_id", F.col("digest").alias("wanted"), "first").where("doc_id = first").drop("first"), "doc_id")
    whole = copies.select("doc_id", F.array(F.struct(F.lit(0).alias("start"), F.lit(2**31 - 1).alias("stop"))).alias("i"), F.col("digest").alias("wanted"))
    found = stored(found.select("doc_id", "i", "wanted").unionByName(whole))
    # Texts that lose nothing stay where they are.
    touched = Bitmap(found.select(F.xxhash64("doc_id").alias("h")), "h").column(F.xxhash64("doc_id"))
    joined = texts.where(touched).join(found, "doc_id", "left")
    mine = F.when(F.col("digest") == F.col("wanted"), F.col("i"))
    limit = lambda c: F.transform(mine, lambda x: F.least(x[c], F.octet_length("text")))
    cut = joined.select("doc_id", "text", limit("start").alias("starts"), limit("stop").alias("stops"))
    none = F.lit(None).cast("array<int>")
    rest = rows.where(~F.coalesce((F.octet_length("text") >= how.window) & F.col("doc_id").isNotNull(), F.lit(False)))
    rest = rest.unionByName(rows.where(long_text).where(~touched)).select("doc_id", "text", none.alias("starts"), none.alias("stops"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return cut.mapInArrow(_cut, schema).unionByName(rest.mapInArrow(_cut, schema))


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
