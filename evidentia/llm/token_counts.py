"""Token counts under a unigram segmentation, with a trie of pre-tokens.

The count of a text is the sum over its pre-tokens (words with a space mark in
front) of the number of pieces on the best path, i.e. the segmentation of the
highest total score; among equals the one with fewer pieces. The forward score
of a prefix depends on the prefix alone, so distinct pre-tokens are inserted in
a trie and each node's score is computed once for all words below it; terminal
nodes store counts. Walking the sorted words is a depth-first walk of that trie
that keeps only the current branch, so memory is bounded by the longest word.

The vocabulary is the given model file; its pieces rank by frequency and no
tokenizer is trained, so a piece of rank r scores -log(r + 1) - log(log(V + 1))
by the rank-frequency rule. A character in no piece costs as many tokens as it
has UTF-8 bytes, at the lowest score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from evidentia.llm.common import columns

MARK = "▁"
_KEEP, _LONGEST = 300_000, 64


class UnigramCounter:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as schema

        model = schema.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        names = [p.piece for p in model.pieces if p.type == schema.ModelProto.SentencePiece.NORMAL]
        base = math.log(math.log(len(names) + 1))
        self.score = {name: -math.log(rank + 2) - base for rank, name in enumerate(names)}
        self.lowest = -math.log(len(names) + 2) - base
        self.longest = max(map(len, names))
        #: pieces by last character: their lengths, so that few look-ups fail
        self.lengths: dict[str, tuple[int, ...]] = {}
        for name in names:
            self.lengths[name[-1]] = (*self.lengths.get(name[-1], ()), len(name))
        self.lengths = {c: tuple(sorted(set(n))) for c, n in self.lengths.items()}
        self._new: dict[str, int] = {}
        self._old: dict[str, int] = {}

    def counts(self, words: list[str]) -> list[int]:
        """Pieces on the best path of each of the sorted distinct ``words``."""
        out, branch, last = [], [(0.0, 0)], ""
        for word in words:
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            del branch[shared + 1 :]
            for at in range(shared, len(word)):
                branch.append(self._forward(word, at + 1, branch))
            out.append(-branch[-1][1])
            last = word
        return out

    def _forward(self, word: str, end: int, branch: list[tuple[float, int]]) -> tuple[float, int]:
        """Best (score, minus pieces) of the prefix of length ``end``."""
        best = None
        for length in self.lengths.get(word[end - 1], ()):
            if length > end:
                break
            got = self.score.get(word[end - length : end])
            if got is not None:
                before = branch[end - length]
                option = before[0] + got, before[1] - 1
                if best is None or option > best:
                    best = option
        if word[end - 1] not in self.score:
            tokens = len(word[end - 1].encode())
            option = branch[end - 1][0] + tokens * self.lowest, branch[end - 1][1] - tokens
            if best is None or option > best:
                best = option
        return best

    def batch(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """(tokens, pre-tokens) of each text."""
        tokens, sizes = [], []
        group: list[list[str]] = []
        size = 0
        for text in texts:
            words = text.encode("utf-8", "surrogatepass").split() if text else []
            group.append(words)
            size += len(words)
            if size > 500_000:
                tokens += self._group(group)
                sizes += map(len, group)
                group, size = [], 0
        tokens += self._group(group)
        sizes += map(len, group)
        return tokens, sizes

    def _group(self, group: list[list[bytes]]) -> list[int]:
        if len(self._new) >= _KEEP:
            self._old, self._new = self._new, {}
        new, old = self._new, self._old
        own: dict[bytes, int] = {}
        fresh = set()
        for word in set().union(*group):
            got = new.get(word)
            if got is None:
                got = old.get(word)
            if got is None:
                fresh.add(word)
            else:
                own[word] = new[word] = got
        ordered = sorted((MARK + w.decode("utf-8", "surrogatepass"), w) for w in fresh)
        for (_, word), count in zip(ordered, self.counts([p for p, _ in ordered])):
            own[word] = count
            if len(word) <= _LONGEST:
                new[word] = count
        return [sum(map(own.__getitem__, words)) for words in group]


_COUNTERS: dict[str, UnigramCounter] = {}


def counter(path: str):
    """A vectorised function: text -> (n_tokens, n_words)."""

    @F.pandas_udf("n_tokens long, n_words long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if path not in _COUNTERS:
            _COUNTERS[path] = UnigramCounter(path)
        for texts in batches:
            tokens, sizes = _COUNTERS[path].batch(texts.tolist())
            yield pd.DataFrame({"n_tokens": tokens, "n_words": sizes})

    return counted.asNondeterministic()


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and n_words (long).

    Words are separated by [\\x20\\x09-\\x0D]. Null and empty texts and texts of
    blanks have no token. Rows are independent; repeated rows and further
    columns pass through, columns with these names are replaced. ``path`` must
    name the same file on every executor.
    """
    rows = docs.drop("n_tokens", "n_words").withColumn("__c", counter(path)(F.col(text)))
    return rows.select(*columns(rows, "__c"), "__c.*")
