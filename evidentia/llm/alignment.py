"""Alignment of the tokens of two tokenizers by their bytes.

The end offsets of A's and B's tokens are two sorted lists; merging them cuts a
text into stretches that lie in one token of each, so every stretch is one link
(a pair of token occurrences that overlap). Ends in both lists close a group.

The merge is cut into pieces of equal work: for each of evenly spaced diagonals
a binary search finds how many of its first elements come from A and how many
from B (the merge path), so pieces are independent of each other and of where
texts begin. All texts of a batch are merged as one list, as every text ends in
an end of both. A piece emits its links and the common ends in it; the pieces
are stitched at the end: a group that reaches over borders is what lies between
two common ends, whichever pieces they come from.

How many documents hold an id pair is counted by Spark over all documents. The
most frequent pairs, a bounded number, are broadcast; pairs beyond the bound
are joined by key, and are rare by construction.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from evidentia.llm import merge_automaton, pieces
from evidentia.llm.common import stored

#: Ends in a piece of the merge; characters and rows of texts merged as one list.
PIECE, _CHARACTERS, _ROWS = 1 << 16, 1 << 20, 500
#: Broadcast pairs: at most so many, 8 bytes for the pair and 8 for its count.
KNOWN_PAIRS = 1 << 21
#: Characters without white space, or of white space alone, that a library's search may not take.
_RUN = 10_000
_RUNS = re.compile(rf"\S{{{_RUN}}}|\s{{{_RUN}}}")


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first d elements of the merge of sorted ``a`` and ``b`` come from ``a``, for each d.

    Equal elements: those of ``a`` first. All binary searches go in step.
    """
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        open_ = low < high
        left = a[np.minimum(middle, len(a) - 1)]
        right = b[np.clip(diagonals - middle - 1, 0, len(b) - 1)]
        more = open_ & (left <= right)
        low = np.where(more, middle + 1, low)
        high = np.where(open_ & ~more, middle, high)
    return low


def merge_piece(a: np.ndarray, b: np.ndarray, a0: int, b0: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of one piece: the token of A and of B in each stretch that ends in the piece, and whether both end there.

    ``a`` and ``b`` are the ends of the piece, ``a0`` and ``b0`` the ones before it.
    An end of both lists counts once, in the piece that holds B's.
    """
    of_a, of_b = np.searchsorted(b, a, "left"), np.searchsorted(a, b, "right")
    both = np.zeros(len(b), bool)
    if len(a):
        both = (of_b > 0) & (a[np.maximum(of_b - 1, 0)] == b)
    # A's ends that B shares are reported with B's: inside the piece by the mask, across its border by the caller
    alone = np.ones(len(a), bool)
    alone[of_b[both] - 1] = False
    index_a = np.r_[np.arange(len(a))[alone], of_b - both]
    index_b = np.r_[of_a[alone], np.arange(len(b))]
    shared = np.r_[np.zeros(int(alone.sum()), bool), both]
    order = np.argsort(np.r_[a[alone], b], kind="stable")
    return index_a[order] + a0, index_b[order] + b0, shared[order]


def links(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of two lists of ends with one last end: indexes into A and B in order, and which links close a group."""
    total = len(a) + len(b)
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(bool)
    diagonals = np.unique(np.r_[np.arange(0, total, piece), total])
    cut_a = merge_path(a, b, diagonals)
    cut_b = diagonals - cut_a
    # A border between the equal ends of A and B: A's end goes over to the piece that holds B's.
    split = (cut_a > 0) & (cut_b < len(b)) & (a[np.maximum(cut_a - 1, 0)] == b[np.minimum(cut_b, len(b) - 1)])
    cut_a = cut_a - split
    found = [
        merge_piece(a[cut_a[i] : cut_a[i + 1]], b[cut_b[i] : cut_b[i + 1]], int(cut_a[i]), int(cut_b[i]))
        for i in range(len(diagonals) - 1)
    ]
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _digits(top: int) -> np.ndarray:
    """Each id below ``top`` in decimal with a free byte before it, padded to one width with zero bytes."""
    return np.array([f"?{i}" for i in range(top)], "S").view("u1").reshape(top, -1).copy()


class Aligner:
    """Tokens of two vocabulary files, aligned for many texts at a time.

    Two libraries encode: their native code takes a third of the time of the
    codecs of this package, which give the bytes of each id. Texts whose letters
    depend on the version of Unicode, or with very long runs, are encoded by the
    byte-level codec itself.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        self.a, self.b = merge_automaton.codec(path_a, special=False), pieces.codec(path_b)
        ranks = {label: token for label, token in self.a.automaton.formed.items()}
        self._encode_a = tiktoken.Encoding("own", pat_str=merge_automaton.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._encode_b = sentencepiece.SentencePieceProcessor(model_file=path_b).encode
        self.size_a = np.array([len(x) for x in self.a.label])
        self.size_b = np.array([len(x) for x in self.b.shown])
        self.shown = _digits(max(len(self.size_a), len(self.size_b)))

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and the text by A, of the text by B; none if the bytes of either differ from that."""
        none = np.zeros(0, "<u4")
        if not text:
            return none, none
        native = merge_automaton.settled(text) and not (len(text) > _RUN and _RUNS.search(text))
        a = self._encode_a(" " + text) if native else np.frombuffer(self.a.spaced(text), "<u4").tolist()
        b = self._encode_b(text)
        want = b" " + text.encode()
        for ids, labels in ((a, self.a.label), (b, self.b.shown)):
            if b"".join(map(labels.__getitem__, ids)) != want:
                return none, none
        return np.array(a, "<u4"), np.array(b, "<u4")

    def align(self, texts: list[str | None], piece: int = PIECE) -> Iterator[dict]:
        """For each text n_a, n_b, n_groups, n_links, groups (text), and its id pairs with how often each is linked."""
        tokens = [self.tokens(t) for t in texts]
        ids_a, ids_b = (np.concatenate([np.zeros(0, "<u4"), *ids]).astype(np.int64) for ids in zip(*tokens))
        link_a, link_b, closes = links(np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b]), piece)
        # Stitch: a link's group is the number of common ends before it, in any piece.
        group = np.cumsum(closes) - closes
        first_a, first_b = np.cumsum([0, *(len(a) for a, _ in tokens)]), np.cumsum([0, *(len(b) for _, b in tokens)])
        text_of_link = np.searchsorted(first_a[1:], link_a, "right")
        bounds = np.searchsorted(text_of_link, np.arange(len(texts) + 1))
        shown, ends = self._shown(ids_a, ids_b, link_a, link_b, group)
        # Number of tokens before each text gives the place of its groups in the text of all.
        before = np.r_[0, ends][first_a + first_b]
        pair = ids_a[link_a] << 32 | ids_b[link_b]
        for i, (a, b) in enumerate(tokens):
            here = slice(bounds[i], bounds[i + 1])
            pairs, times = np.unique(pair[here], return_counts=True)
            yield {
                "n_a": len(a),
                "n_b": len(b),
                "n_groups": int(closes[here].sum()),
                "n_links": here.stop - here.start,
                "groups": shown[before[i] + 1 : before[i + 1]],
                "pairs": pairs,
                "times": times,
            }

    def _shown(self, ids_a, ids_b, link_a, link_b, group) -> tuple[bytes, np.ndarray]:
        """Groups of all texts as text, each token with the sign before it; where each token ends."""
        n_a, n_b = len(ids_a), len(ids_b)
        group_a, group_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
        group_a[link_a], group_b[link_b] = group, group
        groups = np.arange(group[-1] + 1 if len(group) else 0)
        # In a group A's tokens stand before B's: a token's place is its own number plus that of the others before it.
        place_a = np.arange(n_a) + np.searchsorted(group_b, group_a, "left")
        place_b = np.arange(n_b) + np.searchsorted(group_a, group_b, "right")
        width = self.shown.shape[1]
        table = np.empty((n_a + n_b, width), "u1")
        table[place_a], table[place_b] = self.shown[ids_a], self.shown[ids_b]
        table[:, 0] = ord(",")
        table[place_b[np.searchsorted(group_b, groups)], 0] = ord("|")
        table[place_a[np.searchsorted(group_a, groups)], 0] = ord(";")
        used = table != 0
        return table[used].tobytes(), np.cumsum(used.sum(axis=1))


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def align(docs: DataFrame, path_a: str, path_b: str, groups: bool = True, piece: int = PIECE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times, groups) for each row of (doc_id, text).

    ``pairs`` holds the distinct linked id pairs, ``A << 32 | B``, and ``times``
    how often each is linked; ``groups`` the groups as text, if asked for. Null
    and empty texts, and those whose bytes are not those of both encodings, have
    no tokens: zeros, empty lists, an empty groups_sha256. Repeated rows and null
    doc_ids pass through; further columns are left out; an empty table gives an
    empty one. A long text is merged piece by piece.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>, groups string"

    def rows(keys: pa.Array, texts: list) -> pa.RecordBatch:
        found = list(_aligner(path_a, path_b).align(texts, piece))
        columns = [keys, *(pa.array([f[c] for f in found], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links"))]
        columns.append(pa.array([hashlib.sha256(f["groups"]).hexdigest() if f["n_a"] else "" for f in found], pa.string()))
        for name, kind in (("pairs", pa.int64()), ("times", pa.int32())):
            ends = np.cumsum([0, *(len(f[name]) for f in found)]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.int64), *(f[name] for f in found)])
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind)))
        columns.append(pa.array([f["groups"].decode() if groups else None for f in found], pa.string()))
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, start, size = batch["text"].to_pylist(), 0, 0
            for at, text in enumerate(texts):
                size += len(text or "")
                if size >= _CHARACTERS or at + 1 - start >= _ROWS or at + 1 == len(texts):
                    yield rows(batch["doc_id"].slice(start, at + 1 - start), texts[start : at + 1])
                    start, size = at + 1, 0

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many rows hold each pair, and whether that is the highest count of its A id.

    The highest counts have a row for each id of A's vocabulary at most.
    """
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")))
    of_a = F.shiftright("pair", 32)
    highest = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("highest"))
    return counts.join(F.broadcast(highest), of_a == F.col("a")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _frequent(counts: DataFrame, most: int) -> int:
    """The least count such that at most ``most`` pairs reach it."""
    # Counts in steps of a 32nd of a power of two: some thousand rows at the very most.
    step = F.floor(F.log2("n") * 32)
    left = most
    least = 1 << 62
    for row in counts.groupBy(step.alias("step")).agg(F.count("*").alias("m"), F.min("n").alias("least")).orderBy(F.desc("step")).collect():
        left -= row["m"]
        if left < 0:
            break
        least = row["least"]
    return least


def link_counts(aligned: DataFrame, known: int = KNOWN_PAIRS) -> DataFrame:
    """``aligned`` without its lists, with n_best and count_sum.

    n_best counts the links whose pair has the highest count of its A id, ties
    included; count_sum adds the counts of all links. ``known`` bounds the
    broadcast pairs and changes no result.
    """
    spark = aligned.sparkSession
    counts = stored(pair_counts(aligned))
    least = _frequent(counts, known)
    table = counts.where(F.col("n") >= least).select("pair", F.when(F.col("best"), F.col("n")).otherwise(-F.col("n")).alias("n")).toArrow()
    pair, n = (table[c].to_numpy() for c in ("pair", "n"))
    order = np.argsort(pair)
    shared = spark.sparkContext.broadcast((pair[order], n[order]))
    names = [c for c in aligned.columns if c not in ("pairs", "times", "groups")]
    numbered = aligned.select("*", F.monotonically_increasing_id().alias("row"))  # rows of a stored table: the same each time

    @F.arrow_udf("struct<n_best:long,count_sum:long,pairs:array<long>,times:array<int>>")
    def looked_up(pairs: pa.Array, times: pa.Array) -> pa.Array:
        keys, counts = shared.value
        starts = pairs.offsets.to_numpy().astype(np.int64)
        starts, mine, often = starts - starts[0], pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        at = np.searchsorted(keys, mine)
        hit = np.zeros(len(mine), bool)
        hit[at < len(keys)] = keys[at[at < len(keys)]] == mine[at < len(keys)]
        count = np.zeros(len(mine), np.int64)
        count[hit] = counts[at[hit]]
        totals = [np.r_[0, np.cumsum(x)][starts] for x in (np.where(count > 0, often, 0), np.abs(count) * often, ~hit)]
        best, total, missed = totals
        ends = pa.array(missed.astype(np.int32))
        rest = [pa.ListArray.from_arrays(ends, pa.array(x[~hit], kind)) for x, kind in ((mine, pa.int64()), (often, pa.int32()))]
        return pa.StructArray.from_arrays([pa.array(np.diff(best)), pa.array(np.diff(total)), *rest], ["n_best", "count_sum", "pairs", "times"])

    found = numbered.select("row", *names, looked_up("pairs", "times").alias("found"))
    found = stored(found.select("row", *names, "found.*"))
    rare = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    rest = counts.where(F.col("n") < least).withColumnRenamed("pair", "pairs")
    rare = rare.join(rest, "pairs").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more")
    )
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).cast("long").alias(a)
    return found.join(rare, "row", "left").select(*names, plus("n_best", "more_best"), plus("count_sum", "more"))


def link_documents(docs: DataFrame, path_a: str, path_b: str, known: int = KNOWN_PAIRS) -> DataFrame:
    """Per row of (doc_id, text): its tokens, groups and links, and what the corpus says of the links."""
    aligned = stored(align(docs, path_a, path_b, groups=False))
    return link_counts(aligned, known).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
