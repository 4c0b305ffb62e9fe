"""SentencePiece encoding and decoding with a table of last tokens.

Every prefix of a text has one encoding under the merge rules, so one token is
the last of each prefix. An automaton over the pieces gives the tokens that end
at a position; the one that is right forms a *compatible pair* with the last
token of the prefix before it, i.e. no merge would ever join symbols across
their border. One pass fills the table, and the ids are recovered backwards.

A merge joins neighbours only if some piece holds both, so a text falls apart
exactly wherever no piece holds the two characters that meet (before a space
mark, around a character that is no piece). Units, space marks with the word
behind them, are encoded once for each
worker and kept in a cache of bounded size; long units are not kept.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from operator import add

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

MARK = "▁"
_UNIT = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
_NEVER = 1 << 60
#: Cached units and parts, length of a cached one, rows of a batch of results.
_KEEP, _LONGEST, _ROWS = 200_000, 48, 500


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class PieceCodec:
    """Encoder and decoder of one model file (merge type, byte fallback, identity normalisation)."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as schema

        model = schema.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("only identity normalisation with a leading space is supported")
        if train.model_type != train.BPE or not train.byte_fallback:
            raise ValueError("only merge-type models with byte fallback are supported")
        kind = schema.ModelProto.SentencePiece
        self.begin, self.end = train.bos_id, train.eos_id
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        self.names: list[str] = []
        self.rank: list[float] = []
        self.shown: list[bytes] = []
        for i, piece in enumerate(model.pieces):
            self.names.append(piece.piece)
            self.rank.append(-piece.score)
            self.shown.append(b"")
            if piece.type == kind.NORMAL:
                self.ids[piece.piece] = i
                self.shown[i] = piece.piece.replace(MARK, " ").encode()
            elif piece.type == kind.BYTE:
                self.bytes[int(piece.piece[3:-1], 16)] = i
                self.shown[i] = bytes([int(piece.piece[3:-1], 16)])
            elif piece.type not in (kind.CONTROL, kind.UNKNOWN):
                raise ValueError(f"piece type of {piece.piece!r} is not supported")
        self.single = frozenset(p for p in self.ids if len(p) == 1)
        self.runs = {len(p): i for p, i in self.ids.items() if set(p) == {MARK}}
        words = [p for p in self.ids if len(p) > 1 and set(p) != {MARK}]
        if any(MARK in p[1:] or not self.single.issuperset(p) for p in words) or 1 not in self.runs:
            raise ValueError("pieces do not fall apart at spaces and unknown characters")
        self.adjacent = {p[i : i + 2] for p in words for i in range(len(p) - 1)}
        last = {self.rank[i] for n, i in self.runs.items() if n > 1}
        if len(last) > 1 or min(last, default=_NEVER) <= max(self.rank[self.ids[p]] for p in words):
            raise ValueError("runs of spaces must merge last, all with one rank")
        self.length = [len(n) for n in self.names]
        self._trees: dict[int, tuple | None] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in (*words, *self.single):
            if self._tree(self.ids[piece]) is not None:  # else merging never forms it
                self.automaton.add_word(piece, self.ids[piece])
        self.automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        self._parts: dict[str, list[int]] = {}
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    # -- which pairs can stand side by side ----------------------------------

    def _tree(self, token: int) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
        """Spines of a token, from its outer character up to itself: (left, right); None if merging never forms it."""
        if token not in self._trees:
            parts = [(self.ids[c], (self.ids[c],), (self.ids[c],)) for c in self.names[token]]
            while len(parts) > 1:
                joined = [self.ids.get(self.names[a[0]] + self.names[b[0]]) for a, b in zip(parts, parts[1:])]
                options = [(self.rank[j], i) for i, j in enumerate(joined) if j is not None]
                if not options:
                    break
                at = min(options)[1]
                new, a, b = joined[at], parts[at], parts[at + 1]
                parts[at : at + 2] = [(new, (*a[1], new), (*b[2], new))]
            self._trees[token] = parts[0][1:] if len(parts) == 1 else None
        return self._trees[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the text of both tokens gives exactly these two.

        The symbols that meet at the border live from the merge that makes them
        to the merge that takes them up. The border holds if no two that meet
        would be joined before either is taken up; equal ranks go leftmost first.
        """
        return self._holds(self._trees[left][1], self._trees[right][0])

    def _holds(self, west: tuple[int, ...], east: tuple[int, ...]) -> bool:
        i = j = 0
        while True:
            west_ends = self.rank[west[i + 1]] if i + 1 < len(west) else _NEVER
            east_ends = self.rank[east[j + 1]] if j + 1 < len(east) else _NEVER
            across = self.ids.get(self.names[west[i]] + self.names[east[j]])
            if across is not None and self.rank[across] < west_ends and self.rank[across] <= east_ends:
                return False
            if west_ends == east_ends == _NEVER:
                return True
            if west_ends <= east_ends:
                i += 1
            else:
                j += 1

    # -- encoding ---------------------------------------------------------------

    def last_tokens(self, text: str) -> list[int]:
        """The last token of each prefix of ``text`` (known characters, no inner space mark)."""
        table = [-1] * len(text)
        length, pairs = self.length, self._pairs
        if len(pairs) > 500_000:
            pairs.clear()
        for end, token in self.automaton.iter(text):
            if table[end] < 0:
                before = end - length[token]
                if before < 0:
                    table[end] = token
                    continue
                key = table[before] << 32 | token
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = self.compatible(table[before], token)
                if fits:
                    table[end] = token
        return table

    def _backwards(self, text: str) -> bytes:
        table, length, out, at = self.last_tokens(text), self.length, [], len(text) - 1
        while at >= 0:
            token = table[at]
            out.append(token)
            at -= length[token]
        return _packed(out[::-1])

    def _run(self, marks: int) -> bytes:
        """Space marks alone: all runs rank alike, so the leftmost pair that makes a piece merges first."""
        sizes: list[int] = []
        for _ in range(marks):
            sizes.append(1)
            while len(sizes) > 1 and sizes[-2] + sizes[-1] in self.runs:
                sizes[-2:] = [sizes[-2] + sizes[-1]]
        return _packed([self.runs[n] for n in sizes])

    def _part(self, text: str) -> bytes:
        """Ids of characters among which merges may happen, or of one in no piece (its bytes)."""
        got = self._parts.get(text)
        if got is None:
            known = len(text) > 1 or text in self.single
            got = self._backwards(text) if known else _packed([self.bytes[b] for b in text.encode()])
            if len(text) <= _LONGEST:
                if len(self._parts) >= _KEEP:
                    self._parts.clear()
                self._parts[text] = got
        return got

    def unit(self, unit: str) -> bytes:
        """Ids of a run of space marks and the word behind it."""
        word = unit.lstrip(MARK)
        marks = len(unit) - len(word)
        text = MARK + word if marks else word
        cuts = [i for i, pair in enumerate(map(add, text, text[1:]), 1) if pair not in self.adjacent]
        out = [self._part(text[a:b]) for a, b in zip([0, *cuts], [*cuts, len(text)])]
        if marks > 1:
            alone = out[0][:4] == _packed([self.runs[1]])
            out[0] = self._run(marks - (not alone)) + out[0][4 * alone :]
        return b"".join(out)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids with begin and end, as unsigned 32-bit integers. Null is the empty text."""
        units = _UNIT.findall(MARK + text.replace(" ", MARK)) if text else []
        new, old, found = self._new, self._old, []
        for unit in units:
            got = new.get(unit)
            if got is None:
                got = old.get(unit)
                if got is None:
                    got = self.unit(unit)
                if len(unit) <= _LONGEST:
                    if len(new) >= _KEEP:
                        self._old = old = new
                        self._new = new = {}
                    new[unit] = got
            found.append(got)
        return np.frombuffer(b"".join([_packed([self.begin]), *found, _packed([self.end])]), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: begin and end show nothing, bytes are put together, the leading space goes."""
        shown = b"".join(map(self.shown.__getitem__, ids.tolist()))
        return (shown[1:] if shown[:1] == b" " else shown).decode("utf-8", "replace")


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The codec of a model file, built once in each process."""
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def decoder(path: str):
    """A vectorised function: ids as binary -> text."""

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids in batches:
            own = codec(path)
            yield pa.array([None if i is None else own.decode(np.frombuffer(i, "<u4")) for i in ids.to_pylist()], pa.string())

    return decoded


def tokenise(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ids (little-endian unsigned 32-bit integers, binary), n_tokens and decoded (text).

    Null and empty texts give begin and end alone and decode to the empty text.
    Rows are independent: repeated rows, null keys and further columns pass
    through; columns of these names are replaced. ``path`` must name the same
    file on every executor.
    """
    docs = docs.drop("ids", "n_tokens", "decoded")
    names, at_text = docs.columns, docs.columns.index(text)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])  # any name may be in a frame, not in this kind of map
    schema = T.StructType([*plain.schema.fields, *T._parse_datatype_string("ids binary, n_tokens long, decoded string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(at, _ROWS)
                ids = [own.encode(t) for t in rows.column(at_text).to_pylist()]
                new = [
                    pa.array([i.tobytes() for i in ids], pa.binary()),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([own.decode(i) for i in ids], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*rows.columns, *new], schema.names)

    return plain.mapInArrow(run, schema).toDF(*names, "ids", "n_tokens", "decoded")


def digest(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
