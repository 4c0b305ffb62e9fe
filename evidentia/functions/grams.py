"""Character n-grams of masked texts, counted per key within a task.

The rows of a key come one behind the other. n-grams stay inside space-padded
words, so texts are cut into chunks of bounded size, whose counts add up; only
the counts of the key at the end of a chunk wait for the next one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Characters counted at once. Longer texts are cut at a space.
CHUNK = 1 << 20
_SPACE = 32


def counter(sizes: tuple[int, ...], chunk: int = CHUNK) -> Callable:
    """Function over Arrow batches of (keys, first, text) that gives (keys, token, tf); sizes of two or more.

    ``first`` marks the first row of a key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, waiting, counts = None, None, Counter()

        def waited() -> pa.RecordBatch:
            rows = pa.array(np.zeros(len(counts), dtype="int64"))
            arrays = [k.take(rows) for k in waiting] + [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            keys = batch.columns[:-2]
            names = [*batch.schema.names[:-2], "token", "tf"]
            for starts, rows, texts in _chunks(batch, chunk):
                if starts and waiting is not None:
                    yield waited()
                if starts or waiting is None:
                    counts = Counter()
                last = len(rows) - 1
                goes_on, before = Counter(), counts
                for owner, tokens, tf in _count(texts, sizes):
                    # the first key adds to what waits, the last one waits
                    low = int(np.searchsorted(owner, 1)) if not starts and last else 0
                    high = int(np.searchsorted(owner, last))
                    if low:
                        before.update(dict(zip(tokens.slice(0, low).to_pylist(), tf[:low].tolist())))
                    goes_on.update(dict(zip(tokens.slice(high).to_pylist(), tf[high:].tolist())))
                    if low < high:
                        at = pa.array(np.asarray(rows)[owner[low:high]])
                        yield pa.RecordBatch.from_arrays(
                            [k.take(at) for k in keys] + [tokens.slice(low, high - low), pa.array(tf[low:high])], names
                        )
                if last:
                    if not starts and waiting is not None:
                        yield waited()
                    counts = goes_on
                else:
                    counts.update(goes_on)
                waiting = [k.slice(rows[last], 1) for k in keys]
        if waiting is not None:
            yield waited()

    return run


def _pieces(text: str, chunk: int) -> Iterator[str]:
    begin = 0
    while len(text) - begin > chunk:
        cut = text.rfind(" ", begin + 1, begin + chunk)
        if cut < 0:
            cut = text.find(" ", begin + chunk)
        if cut < 0:
            break
        yield text[begin:cut]
        begin = cut + 1
    yield text[begin:]


def _chunks(batch: pa.RecordBatch, chunk: int) -> Iterator[tuple[bool, list[int], list[list[str]]]]:
    """(whether the first key starts here, a row of each key, texts of each key)."""
    begins, rows, texts, size = True, [], [], 0
    for row, (first, text) in enumerate(zip(batch.column(-2).to_pylist(), batch.column(-1).to_pylist())):
        for i, piece in enumerate(_pieces(text, chunk)):
            new = first and i == 0
            if rows and size + len(piece) > chunk:
                yield begins, rows, texts
                rows, texts, size = [], [], 0
            if not rows:
                begins = new
            if new or not rows:
                rows.append(row)
                texts.append([])
            texts[-1].append(piece)
            size += len(piece) + 2
    if rows:
        yield begins, rows, texts


def _count(texts: list[list[str]], sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """For each size (number of the key, ascending; token; occurrences)."""
    # two spaces between texts: no n-gram reaches over them
    joined = [" " + "  ".join(parts) + " " for parts in texts]
    chars = np.frombuffer("".join(joined).encode("utf-32-le"), "<u4")
    owner = np.repeat(np.arange(len(joined)), [len(j) for j in joined])
    space = chars == _SPACE
    alphabet = np.flatnonzero(np.bincount(chars))
    number = np.zeros(int(alphabet[-1]) + 1, dtype="int64")
    number[alphabet] = np.arange(len(alphabet))
    letters = number[chars]
    bits, owners = max(1, int(len(alphabet) - 1).bit_length()), len(joined).bit_length()
    for n in sizes:
        length = len(chars) - n + 1
        if length < 1:
            continue
        inside = ~(space[:length] & space[1 : length + 1])
        for j in range(1, n - 1):
            inside &= ~space[j : j + length]
        at = np.flatnonzero(inside)
        if not len(at):
            continue
        if owners + n * bits < 64:
            code = owner[at]
            for j in range(n):
                code = code << bits | letters[at + j]
            code.sort()
            begin = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            tf = np.diff(begin, append=len(code))
            code = code[begin]
            found = alphabet[code[:, None] >> (np.arange(n - 1, -1, -1) * bits) & ((1 << bits) - 1)]
            yield code >> (n * bits), _strings(found), tf
        else:  # large alphabets: the letters so far are replaced by their rank
            code, width = owner[at], owners
            for j in range(n):
                if width + bits > 63:
                    distinct, code = np.unique(code, return_inverse=True)
                    width = len(distinct).bit_length()
                code, width = code << bits | letters[at + j], width + bits
            _, begin, tf = np.unique(code, return_index=True, return_counts=True)
            yield owner[at[begin]], _strings(chars[at[begin][:, None] + np.arange(n)]), tf


def _strings(chars: np.ndarray) -> pa.Array:
    """Rows of code points as strings."""
    width = 1 + (chars > 0x7F).astype("int32") + (chars > 0x7FF) + (chars > 0xFFFF)
    ends = np.concatenate([[0], np.cumsum(width.sum(axis=1))]).astype("int32")
    data = chars.astype("<u4").tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(chars), pa.py_buffer(ends), pa.py_buffer(data))


# -- counts of a whole task, and counts of known n-grams alone ----------------------------------

#: Distinct n-grams that a task gathers before it hands them on.
GATHERED = 1 << 20
#: Letters below this code point are gathered as numbers, twelve bits each.
_PLAIN, _PLAIN_BITS, _PLAIN_SIZE = 1 << 12, 12, 5


def whole_keys(batches: Iterator[pa.RecordBatch], chunk: int, cut: bool = True) -> Iterator[tuple[list[tuple], list[list[str]], bool, bool]]:
    """(other columns of each key, texts of each key, whether the first key begins and the last one ends here).

    Batches end with the columns ``first`` and ``text``. Only a key of more
    than ``chunk`` characters comes in parts, each of which is alone.
    """
    held, texts, size, last, begins = [], [], 0, 0, True  # characters held, and those of the last key
    for batch in batches:
        other = list(zip(*(c.to_pylist() for c in batch.columns[:-2]))) or [()] * batch.num_rows
        for own, first, text in zip(other, batch.column(-2).to_pylist(), batch.column(-1).to_pylist()):
            for i, piece in enumerate(_pieces(text or "", chunk) if cut else [text or ""]):
                if first and not i:
                    if held and (not begins or size + len(piece) > chunk):
                        yield held, texts, begins, True
                        held, texts, size, begins = [], [], 0, True
                    held.append(own)
                    texts.append([])
                    last = 0
                elif last and size + len(piece) > chunk:
                    if len(held) > 1:
                        yield held[:-1], texts[:-1], True, True
                        held, texts, size = held[-1:], texts[-1:], last
                    if size + len(piece) > chunk:
                        yield held, texts, begins, False
                        texts, size, last, begins = [[]], 0, 0, False
                texts[-1].append(piece)
                size, last = size + len(piece) + 2, last + len(piece) + 2
    if held:
        yield held, texts, begins, True


def words_of(texts: list[str], sizes: tuple[int, ...]) -> Counter:
    """Occurrences of the runs of words of one key."""
    found = Counter()
    for text in texts:
        words = [w for w in text.split(" ") if w]
        for n in sizes:
            found.update(words if n == 1 else map(" ".join, zip(*(words[i:] for i in range(n)))))
    return found


def profiler(sizes: tuple[int, ...], words: bool = False, chunk: int = CHUNK // 4) -> Callable:
    """Function over batches of (fold, first, text) that gives (token, fold, df, cf): keys that hold a token, and how often.

    A row is part of a sum: a token may come several times.
    """
    names = ["token", "fold", "df", "cf"]

    def rows(tokens, fold, df, cf) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), *(pa.array(x, pa.int64()) for x in (fold, df, cf))], names)

    def of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, cf, part = Counter(), Counter(), Counter()

        def gathered() -> pa.RecordBatch:
            return rows([t for _, t in cf], [f for f, _ in cf], [df[x] for x in cf], list(cf.values()))

        for held, texts, _, ends in whole_keys(batches, chunk, cut=False):
            for i, ((fold,), own) in enumerate(zip(held, texts)):
                part.update(words_of(own, sizes))
                if ends or i + 1 < len(held):
                    for token, n in part.items():
                        df[fold, token] += 1
                        cf[fold, token] += n
                    part = Counter()
            if len(cf) > GATHERED:
                yield gathered()
                df, cf = Counter(), Counter()
        if cf:
            yield gathered()

    def of_characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, part = _Sums(), Counter()
        for held, texts, begins, ends in whole_keys(batches, chunk):
            if not (begins and ends):  # a part of a key
                for _, tokens, tf in _count(texts, sizes):
                    for token, n in zip(tokens.to_pylist(), tf.tolist()):
                        part[token] += n
                if ends:
                    yield rows(list(part), held[0] * len(part), [1] * len(part), list(part.values()))
                    part = Counter()
                continue
            order = sorted(range(len(held)), key=lambda i: held[i][0])
            fold = np.array([held[i][0] for i in order], dtype="int64")
            for found in _profile([texts[i] for i in order], fold, sizes, sums):
                yield rows(*found)
            if sums.size > 2 * GATHERED:
                sums.fold()
                if sums.size > GATHERED:
                    yield from (rows(*x) for x in sums.taken())
        sums.fold()
        yield from (rows(*x) for x in sums.taken())

    return of_words if words else of_characters


class _Sums:
    """Sums by number (letters of an n-gram, then the fold), gathered from many chunks."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, code: np.ndarray, df: np.ndarray, cf: np.ndarray) -> None:
        if len(code):
            self.parts.append((code, df, cf))
            self.size += len(code)

    def fold(self) -> None:
        if len(self.parts) > 1:
            code, df, cf = (np.concatenate(x) for x in zip(*self.parts))
            order = np.argsort(code)
            code = code[order]
            begin = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            self.parts = [(code[begin], np.add.reduceat(df[order], begin), np.add.reduceat(cf[order], begin))]
            self.size = len(begin)

    def taken(self) -> Iterator[tuple]:
        for code, df, cf in self.parts:
            letters = code >> 3
            for n in range(1, _PLAIN_SIZE + 1):
                mine = (letters >= 1 << _PLAIN_BITS * (n - 1)) & (letters < 1 << _PLAIN_BITS * n)
                chars = letters[mine, None] >> (np.arange(n - 1, -1, -1) * _PLAIN_BITS) & (_PLAIN - 1)
                for at in range(0, len(chars), 1 << 16):
                    here = slice(at, at + (1 << 16))
                    yield _strings(chars[here]), code[mine][here] & 7, df[mine][here], cf[mine][here]
        self.parts, self.size = [], 0


def _profile(texts: list[list[str]], fold: np.ndarray, sizes: tuple[int, ...], sums: _Sums) -> Iterator[tuple]:
    """Adds the n-grams of whole keys, ordered by fold, to ``sums``; gives those whose letters or folds don't fit there."""
    for gram, owner, letters, tf in _runs_of(texts, sizes):
        f = fold[owner]
        begin = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (f[1:] != f[:-1])]))
        df, cf, chars, f = np.diff(begin, append=len(f)), np.add.reduceat(tf, begin), letters(begin), f[begin]
        n = chars.shape[1]
        plain = (chars < _PLAIN).all(axis=1) & (chars[:, 0] > 0) & (f >= 0) & (f < 8) & (n <= _PLAIN_SIZE)
        code = f[plain].astype("int64")
        for j in range(n):
            code |= chars[plain, j].astype("int64") << (3 + _PLAIN_BITS * (n - 1 - j))
        sums.add(code, df[plain], cf[plain])
        if not plain.all():
            yield _strings(chars[~plain]), f[~plain], df[~plain], cf[~plain]


def _runs_of(texts: list[list[str]], sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, Callable, np.ndarray]]:
    """For each size (number of the n-gram, number of the key, letters of some rows, occurrences), ordered by n-gram, then key."""
    chars, owner, alphabet, letters = _letters(texts)
    bits, owners = max(1, int(len(alphabet) - 1).bit_length()), len(texts).bit_length()
    for n in sizes:
        at = _inside(chars, n)
        if not len(at):
            continue
        if owners + n * bits < 64:
            code = letters[:-1] << bits | letters[1:] if n > 1 else letters
            for j in range(2, n):
                code = code[:-1] << bits | letters[j:]
            code = code[at] << owners | owner[at]
            code.sort()
            begin = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            tf, code = np.diff(begin, append=len(code)), code[begin]
            gram, shifts = code >> owners, np.arange(n - 1, -1, -1) * bits
            yield gram, code & ((1 << owners) - 1), lambda rows, g=gram, s=shifts: alphabet[g[rows, None] >> s & ((1 << bits) - 1)], tf
        else:
            found = chars[at[:, None] + np.arange(n)].astype("int64")
            order = np.lexsort((owner[at], *(found[:, j] for j in range(n - 1, -1, -1))))
            found, own = found[order], owner[at][order]
            gram = np.cumsum(np.concatenate([[False], (found[1:] != found[:-1]).any(axis=1)]))
            begin = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (own[1:] != own[:-1])]))
            yield gram[begin], own[begin], lambda rows, x=found[begin]: x[rows], np.diff(begin, append=len(own))


def _letters(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts, a space before and behind each; number of the key; alphabet; places in it."""
    joined = [" " + "  ".join(parts) + " " for parts in texts]
    chars = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(joined)), [len(j) for j in joined])
    alphabet = np.flatnonzero(np.bincount(chars))
    number = np.zeros(int(alphabet[-1]) + 1, dtype="int64")
    number[alphabet] = np.arange(len(alphabet))
    return chars, owner, alphabet, number[chars]


def _inside(chars: np.ndarray, n: int) -> np.ndarray:
    """Where the n-grams inside padded words begin."""
    space, length = chars == _SPACE, max(0, len(chars) - n + 1)
    inside = ~(space[:length] & space[1 : length + 1])
    for j in range(1, n - 1):
        inside &= ~space[j : j + length]
    return np.flatnonzero(inside)


class Finder:
    """Counts the n-grams of a vocabulary alone, each by its place there, by one table of states and letters.

    A state is the row of a prefix: its first cell holds the place (from 1) of the
    token that ends there, the others the row that a letter leads to. Row 0 leads nowhere.
    """

    #: More cells than this are not worth a table.
    MOST = 1 << 24

    def __init__(self, tokens: list[str], sizes: tuple[int, ...]):
        self.tokens, self.listed = len(tokens), tokens
        known = [(t, i) for i, t in enumerate(tokens) if len(t) in sizes and " " not in t[1:-1] and t != "  "]
        alphabet = sorted({ord(c) for t, _ in known for c in t})
        self.number = np.full((alphabet[-1] if alphabet else 0) + 2, 1, "int64")
        self.number[alphabet] = np.arange(2, len(alphabet) + 2)
        self.width, self.sizes = len(alphabet) + 2, tuple(sorted(sizes))
        prefixes = sorted({t[:n] for t, _ in known for n in range(1, len(t) + 1)}, key=len)
        self.cells = (len(prefixes) + 2) * self.width
        if self.cells > self.MOST:
            return
        place = {"": self.width} | {p: (k + 2) * self.width for k, p in enumerate(prefixes)}
        self.table = np.zeros(self.cells, "int32")
        for p in prefixes:
            self.table[place[p[:-1]] + self.number[ord(p[-1])]] = place[p]
        for t, i in known:
            self.table[place[t]] = i + 1

    def __call__(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the key, place of the token, occurrences), ordered."""
        joined = [" " + "  ".join(parts) + " " for parts in texts]
        chars = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), "<u4")
        letters = self.number[np.minimum(chars, len(self.number) - 1)]
        ends = np.cumsum([len(j) for j in joined])
        state, at, hits = self.table.take(self.width + letters), None, []
        for n in range(2, self.sizes[-1] + 1):
            if at is None and n <= max(2, self.sizes[0]):  # most prefixes of this length lead on
                state = self.table.take(state[:-1] + letters[n - 1 :])
            else:
                if at is None:
                    at = np.flatnonzero(state)
                    state = state[at]
                fits = int(np.searchsorted(at, len(letters) - n + 1))
                at = at[:fits]
                state = self.table.take(state[:fits] + letters.take(at + n - 1))
                alive = np.flatnonzero(state)
                at, state = at[alive], state[alive]
            if n in self.sizes:
                token = self.table.take(state)
                hit = np.flatnonzero(token)
                hits.append(((hit if at is None else at[hit]), token[hit] - 1))
        where, token = (np.concatenate(x) for x in zip(*hits))
        owner = np.repeat(np.arange(len(joined)), np.diff(ends, prepend=0))
        counted = np.bincount(owner[where] * self.tokens + token, minlength=1)
        found = np.flatnonzero(counted)
        return found // max(1, self.tokens), found % max(1, self.tokens), counted[found]


class WordFinder:
    """As ``Finder``, for runs of words."""

    cells = 0

    def __init__(self, tokens: list[str], sizes: tuple[int, ...]):
        self.tokens, self.listed, self.sizes, self.place = len(tokens), tokens, sizes, {t: i for i, t in enumerate(tokens)}

    def __call__(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = []
        for owner, own in enumerate(texts):
            found += sorted((owner, self.place[t], n) for t, n in words_of(own, self.sizes).items() if t in self.place)
        return tuple(np.array(x, "int64") for x in zip(*found)) if found else (np.zeros(0, "int64"),) * 3


def vectors(batches: Iterator[pa.RecordBatch], find: Finder | WordFinder, chunk: int = CHUNK // 4) -> Iterator[tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]]:
    """(other columns of some keys, ends of their entries, places, occurrences) of batches that end with ``first`` and ``text``."""
    part = np.zeros(find.tokens, "int64")
    for held, texts, begins, ends in whole_keys(batches, chunk, cut=isinstance(find, Finder)):
        owner, place, n = find(texts)
        if not (begins and ends):  # a part of a key
            np.add.at(part, place, n)
            if not ends:
                continue
            place = np.flatnonzero(part)
            owner, n, part = np.zeros(len(place), "int64"), part[place], np.zeros(find.tokens, "int64")
        yield held, np.searchsorted(owner, np.arange(len(held)), "right"), place, n


def folded(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of runs that follow one another, 0 for an empty one."""
    sizes = np.diff(ends, prepend=0)
    out, full = np.zeros((len(ends), *values.shape[1:])), sizes > 0
    if full.any():
        out[full] = np.add.reduceat(values, (ends - sizes)[full], axis=0)
    return out
