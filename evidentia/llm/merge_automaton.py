"""Byte-level BPE as a deterministic automaton over tokens.

The automaton starts with one state and an arc from it to itself for each byte.
Each merge (a, b) -> c is a gadget put on the automaton built so far: arcs of
``a`` lead to a copy of their state that lacks the arc of ``b``, and wherever an
arc of ``a`` starts, an arc of ``c`` leads on to where ``b`` led. All arcs of one
token lead to one state at any time. After the last merge the automaton accepts
exactly the token sequences that merging gives, so the path that spells a word
is unique, and so is the path to each of its prefixes. Encoding follows the
table from position to position, decoding emits the labels of the arcs.

An arc of ``c`` exists where its left part ``a`` had one when the merge came.
With tokens numbered along the tree of left parts, children in order of their
merges, each gadget takes one interval of numbers away, so a state is a short
sorted table of interval bounds: 14,639 states and 366,000 intervals for 50,000
merges. The automaton is compiled from the vocabulary file in each worker.

Texts are cut by the vocabulary's own rule before that; no pre-token crosses a
space that follows a visible character, so such pieces are encoded once for each
worker and kept in a cache of bounded size; long pieces are not kept.
"""

from __future__ import annotations

import json
import struct
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

#: Fixed value: the rule that cuts texts into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPLIT = regex.compile(PATTERN)
_KNOWN = regex.compile(r"[\p{L}\p{N}]")
#: Below U+0530 all versions of Unicode agree on letters and digits.
_SETTLED = regex.compile("[\0-\u052f]*")
#: Pieces that the rule cuts into letters and marks, or does not cut.
_SIMPLE = regex.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: Cached pieces, length of a cached one, rows of a batch of results.
_KEEP, _LONGEST, _ROWS = 300_000, 48, 500


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def byte_names() -> dict[str, int]:
    """Characters that stand for bytes in the file: visible Latin-1 ones for themselves, others from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@cache
def _younger() -> tuple[regex.Pattern | None, regex.Pattern]:
    """Letters and digits here that are neither to the library that the vocabulary belongs to, and the rule without them.

    Both follow Unicode, in versions that may differ, so its pre-tokenizer is asked for each.
    """
    from tokenizers import pre_tokenizers

    known = _KNOWN.findall("".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000)))))
    asked = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str("".join(f"${c}\n" for c in known))
    starts = {start for _, (start, _) in asked}
    points = np.array([ord(c) for i, c in enumerate(known) if 3 * i + 1 not in starts], int)
    if not len(points):
        return None, _SPLIT
    runs = np.split(points, np.flatnonzero(np.diff(points) > 1) + 1)
    other = "".join(f"{chr(r[0])}-{chr(r[-1])}" for r in runs)
    less = f"(?![{other}])"
    inside = {r" ?\p{L}+": rf" ?(?:{less}\p{{L}})+", r" ?\p{N}+": rf" ?(?:{less}\p{{N}})+", r" ?[^\s\p{L}\p{N}]+": rf" ?(?:[^\s\p{{L}}\p{{N}}]|[{other}])+"}
    return regex.compile(f"[{other}]"), regex.compile("|".join(inside.get(part, part) for part in PATTERN.split("|")))


def settled(text: str) -> bool:
    """Whether all versions of Unicode cut a text alike."""
    return _SETTLED.fullmatch(text) is not None


def pre_tokens(text: str) -> list[str]:
    """A text cut by the rule of the vocabulary."""
    if not settled(text):
        found, rule = _younger()
        if found and found.search(text):
            return rule.findall(text)
    return _SPLIT.findall(text)


class Automaton:
    """States and arcs of a list of merges.

    ``labels`` are the bytes of each token, ``merges`` id triples (left, right,
    joined) in order. A merge that never applies (its right part cannot stand
    behind its left part any more) adds no arc.
    """

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        if len({c for _, _, c in merges}) < len(merges):
            raise ValueError("only one merge may give a token")
        self.labels = labels
        base = sorted(set(labels) - {c for _, _, c in merges})
        if any(len(labels[t]) != 1 for t in base):
            raise ValueError("tokens without a merge must be single bytes")
        self._enumerate(base, merges)
        self._compile(base, merges)

    def _enumerate(self, base: list[int], merges: list[tuple[int, int, int]]) -> None:
        """Number tokens so that each comes behind all tokens that grow from it to the right."""
        children: dict[int, list[tuple[int, int]]] = {t: [] for t in self.labels}
        for k, (a, _, c) in enumerate(merges):
            children[a].append((k, c))
        self.number: dict[int, int] = {}
        self._grown: dict[int, tuple[int, list[int], list[int]]] = {}  # first number below, merges, last number of each
        for root in base:
            open_ = [(root, 0, len(self.number))]
            while open_:
                token, done, first = open_.pop()
                if done < len(children[token]):
                    open_ += [(token, done + 1, first), (children[token][done][1], 0, len(self.number))]
                else:
                    self.number[token] = len(self.number)
                    below = children[token]
                    self._grown[token] = (first, [k for k, _ in below], [self.number[c] for _, c in below])

    def _lost(self, token: int, merge: int) -> tuple[int, int]:
        """Numbers of ``token`` and of what grows from it by ``merge`` or a later one: from, to before."""
        first, merges, last = self._grown[token]
        at = 0
        while at < len(merges) and merges[at] < merge:
            at += 1
        return (last[at - 1] + 1 if at else first), self.number[token] + 1

    def _compile(self, base: list[int], merges: list[tuple[int, int, int]]) -> None:
        start: list[int] = []
        target = {t: start for t in base}
        for k, (a, b, c) in enumerate(merges):
            if a not in target or b not in target or not self.arc(target[a], b):
                continue
            old = target[a]
            low, high = self._lost(b, k)
            at = bisect_right(old, low)
            target[c] = target[b]  # for a merge of a token with itself, the state before the copy
            target[a] = self._joined(old[:at], [low, high], old[at:])
        self.start, self.target = start, target
        #: Tokens that merging forms, by their bytes.
        self.formed = {self.labels[t]: t for t in target}

    @staticmethod
    def _joined(left: list[int], new: list[int], right: list[int]) -> list[int]:
        """A copy of sorted interval bounds with one more interval; neighbours that touch become one."""
        if left and left[-1] == new[0]:
            left, new = left[:-1], new[1:]
        if right and right[0] == new[-1]:
            new, right = new[:-1], right[1:]
        return left + new + right

    def arc(self, state: list[int], token: int) -> bool:
        """Whether ``token`` may follow in a state."""
        return not bisect_right(state, self.number[token]) & 1


class ByteCodec:
    """Encoder and decoder of one vocabulary file (byte-level BPE)."""

    def __init__(self, path: str, special: bool = True):
        """``special``: whether the strings of special tokens in a text are these tokens."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or spec["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]:
            raise ValueError("only byte-level BPE with the usual rule for pre-tokens is supported")
        unusual = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if any(model.get(k) for k in unusual) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("options of the vocabulary file are not supported")
        byte, vocabulary = byte_names(), model["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        labels = {i: bytes(byte[c] for c in name) for name, i in vocabulary.items() if name not in added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.automaton = Automaton(labels, [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs])
        self.label = [b""] * (max([*labels, *added.values()]) + 1)
        for i, label in [*labels.items(), *((i, name.encode()) for name, i in added.items())]:
            self.label[i] = label
        self.added = {name: _packed([i]) for name, i in added.items()} if special else {}
        self._cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self._matcher = ahocorasick.Automaton()
        for label, token in self.automaton.formed.items():
            target, number = self.automaton.target[token], self.automaton.number[token]
            self._matcher.add_word(label.decode("latin-1"), (token, len(label), number, target))
        self._matcher.make_automaton()
        self._whole = {label: _packed([token]) for label, token in self.automaton.formed.items()}
        self._pieces = _Pieces(self)

    def word(self, raw: bytes) -> bytes:
        """Ids of one pre-token: the one path through the automaton that spells it."""
        whole = self._whole.get(raw)
        if whole is not None:
            return whole
        # Per position its state and the arc that led there, as (token, size, number, state)
        states: list = [None] * len(raw)
        arcs: list = [None] * len(raw)
        states.append(self.automaton.start)  # position 0, found at index -1
        for end, arc in self._matcher.iter(raw.decode("latin-1")):
            if arcs[end] is None and not bisect_right(states[end - arc[1]], arc[2]) & 1:
                arcs[end], states[end] = arc, arc[3]
        out, at = [], len(raw) - 1
        while at >= 0:
            arc = arcs[at]
            out.append(arc[0])
            at -= arc[1]
        return _packed(out[::-1])

    def _split(self, text: str) -> bytes:
        return b"".join([self.word(part.encode()) for part in pre_tokens(text)])

    def spaced(self, text: str) -> bytes:
        """Ids of a space and ``text``, as little-endian unsigned 32-bit integers."""
        try:
            return b"".join(list(map(self._pieces.__getitem__, text.split(" "))))
        except TypeError:  # a space meets other white space: pre-tokens may cross it
            return self._split(" " + text)
        finally:
            self._pieces.bound()

    def _plain(self, text: str) -> bytes:
        head, space, rest = text.partition(" ")
        if not space:
            return self._split(text)
        if rest[:1].strip() and not head[-1:].isspace() and head:
            return self._split(head) + self.spaced(rest)
        return self._split(text)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids as unsigned 32-bit integers. Null is the empty text."""
        if not text:
            return np.zeros(0, "<u4")
        if self._cut is None or not any(name in text for name in self.added):
            return np.frombuffer(self._plain(text), "<u4")
        parts = self._cut.split(text)
        return np.frombuffer(b"".join([self.added[p] if i % 2 else self._plain(p) for i, p in enumerate(parts) if p]), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The labels of the arcs in order, as text; special tokens show their names."""
        return b"".join(map(self.label.__getitem__, ids.tolist())).decode("utf-8", "replace")


class _Pieces(dict):
    """Ids of a space and the characters up to the next one; None where white space may join across."""

    def __init__(self, codec: ByteCodec):
        self.codec, self.old = codec, {}

    def __missing__(self, piece: str) -> bytes | None:
        got = self.old.get(piece)
        if got is None:
            got = self._encode(piece) if piece and not piece[0].isspace() else None
        if len(piece) <= _LONGEST:
            self[piece] = got
        return got

    def _encode(self, piece: str) -> bytes:
        simple = _SIMPLE.fullmatch(piece)
        if simple is None:
            return self.codec._split(" " + piece)
        letters, marks = simple.groups()
        return self[letters] + self.codec.word(marks.encode()) if marks else self.codec.word(b" " + piece.encode())

    def bound(self) -> None:
        if len(self) > _KEEP:
            self.old = dict(self)
            self.clear()


_CODECS: dict[tuple[str, bool], ByteCodec] = {}


def codec(path: str, special: bool = True) -> ByteCodec:
    """The codec of a vocabulary file, compiled once in each process."""
    if (path, special) not in _CODECS:
        _CODECS[path, special] = ByteCodec(path, special)
    return _CODECS[path, special]


def decoder(path: str):
    """A vectorised function: ids as binary -> text; null stays null."""

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids in batches:
            own = codec(path)
            yield pa.array([None if i is None else own.decode(np.frombuffer(i, "<u4")) for i in ids.to_pylist()], pa.string())

    return decoded


def tokenise(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ids (little-endian unsigned 32-bit integers, binary), n_tokens and decoded (text).

    Null and empty texts have no ids and decode to the empty text. Strings of
    special tokens in a text are these tokens. Rows are independent: repeated
    rows, null keys and further columns pass through; columns of these three
    names are replaced. Long texts take time in proportion to their length; an
    empty table gives an empty one. ``path`` must name the same file on every
    executor.
    """
    docs = docs.drop("ids", "n_tokens", "decoded")
    names, at_text = docs.columns, docs.columns.index(text)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])  # any name may be in a frame, not in this kind of map
    new = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.StringType())]
    schema = T.StructType([*plain.schema.fields, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(at, _ROWS)
                ids = [own.encode(t) for t in rows.column(at_text).to_pylist()]
                added = [
                    pa.array([i.tobytes() for i in ids], pa.binary()),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([own.decode(i) for i in ids], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*rows.columns, *added], schema.names)

    return plain.mapInArrow(run, schema).toDF(*names, "ids", "n_tokens", "decoded")


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    ids, decoded = F.sha2("ids", 256), F.sha2(F.col("decoded").cast("binary"), 256)
    return rows.select("doc_id", "n_tokens", ids.alias("ids_sha256"), decoded.alias("decoded_sha256"))
