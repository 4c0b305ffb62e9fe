"""Matching-blocks similarity against small closed vocabularies.

The measure is 2M/T over recursively longest matching blocks, which no
built-in function offers. It runs as Arrow-batched pandas UDFs: each batch is
scored once per distinct string, and a value that cannot reach the acceptance
floor is dismissed by the length and letter-count bounds, both of which are
upper bounds of the measure, before any blocks are searched.

Callers pass NULL for rows that need no score; those rows cost nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

MATCH_TYPE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("runner_up", T.DoubleType()),
    ]
)


def make_ratio():
    """``ratio(a, b, floor)``: the similarity, or 0.0 when it is surely below ``floor``."""
    from difflib import SequenceMatcher

    matchers: dict[str, SequenceMatcher] = {}

    def ratio(a: str, b: str, floor: float = 0.0) -> float:
        matcher = matchers.get(b)
        if matcher is None:
            if len(matchers) > 4096:
                matchers.clear()
            matcher = matchers[b] = SequenceMatcher(None, "", b)
        matcher.set_seq1(a)
        if floor > 0.0 and (matcher.real_quick_ratio() < floor or matcher.quick_ratio() < floor):
            return 0.0
        return matcher.ratio()

    return ratio


def pair_ratio(floor: float = 0.0):
    """UDF over two columns, argument order kept (the measure is asymmetric)."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        ratio = make_ratio()
        seen: dict[tuple[str, str], float] = {}

        def one(pair: tuple) -> float | None:
            if pair[0] is None or pair[1] is None:
                return None
            if pair not in seen:
                seen[pair] = ratio(pair[0], pair[1], floor)
            return seen[pair]

        for left, right in batches:
            if len(seen) > REMEMBERED:
                seen.clear()
            yield pd.Series([one(pair) for pair in zip(left, right)], dtype="float64")

    return score


#: Distinct strings a task remembers the scores of.
REMEMBERED = 1 << 17


def label_matches(labels: list[tuple[str, int]], floor: float):
    """UDF: places and scores of the labels (text, words) that a run of words is near; NULL without one.

    A run holds a word more than the label at most. One that contains the
    label scores 1, others by the measure. Each distinct run of a task is
    scored once, and only against labels of about its length.
    """

    @F.pandas_udf("array<struct<place:int,quality:double>>")
    def match(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        ratio = make_ratio()
        seen: dict[tuple[str, int], list[dict] | None] = {}

        def near(run: str, count: int) -> list[dict] | None:
            out = []
            for place, (label, size) in enumerate(labels):
                if count > size + 1:
                    continue
                if label in run:
                    out.append({"place": place, "quality": 1.0})
                elif 2 * min(len(run), len(label)) >= floor * (len(run) + len(label)):
                    quality = ratio(run, label, floor)
                    if quality >= floor:
                        out.append({"place": place, "quality": quality})
            return out or None

        for runs, counts in batches:
            if len(seen) > REMEMBERED:
                seen.clear()
            found = []
            for pair in zip(runs, counts):
                if pair not in seen:
                    seen[pair] = near(*pair)
                found.append(seen[pair])
            yield pd.Series(found, dtype="object")

    return match


def nearest(options: dict[str, str], floor: float = 0.0):
    """UDF: best option, its score and the next score, for each string.

    ``options`` maps an option to the key it is compared by. Equal scores are
    won by the option that sorts last.
    """
    listed = sorted(options.items(), reverse=True)

    @F.pandas_udf(MATCH_TYPE)
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        best = remembered(best_two(listed, floor))
        blank = (None, None, None)
        for needles in batches:
            yield pd.DataFrame([blank if n is None else best(n) for n in needles], columns=["value", "score", "runner_up"])

    return match


def best_two(listed: list[tuple[str, str]], floor: float):
    """Function of a string: best option, its score and the next score (0 at least)."""
    ratio = make_ratio()

    def found(needle: str) -> tuple[str | None, float, float]:
        best, first, second, size = None, -1.0, -1.0, len(needle)
        for option, key in listed:
            # the bound by length, before any matcher is made
            both = size + len(key)
            score = 0.0 if floor > 0.0 and both and 2.0 * min(size, len(key)) / both < floor else ratio(needle, key, floor)
            if score > first:
                best, first, second = option, score, first
            elif score > second:
                second = score
        return best, first, max(second, 0.0)

    return found


def remembered(make):
    """``make`` asked once for each distinct string of a task, as far as they are remembered."""
    seen: dict = {}

    def found(key: str):
        if key not in seen:
            if len(seen) > REMEMBERED:
                seen.clear()
            seen[key] = make(key)
        return seen[key]

    return found


def nearest_each(options: dict[str, str], floor: float = 0.0):
    """As ``nearest`` for every element of an array column."""
    listed = sorted(options.items(), reverse=True)

    @F.pandas_udf(T.ArrayType(MATCH_TYPE))
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        plain = best_two(listed, floor)
        best = remembered(lambda needle: dict(zip(("value", "score", "runner_up"), plain(needle))))
        for groups in batches:
            yield groups.map(lambda group: None if group is None else [best(needle) for needle in group], na_action="ignore")

    return match


def near_pairs(options: dict[str, str], floor: float):
    """UDF: of a text of lines, the options nearest to each two neighbouring words that both are near one, joined by a blank.

    A word is of ASCII letters, apostrophes and hyphens, and starts with a letter; its case does not count.
    """
    listed = sorted(options.items(), reverse=True)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def pairs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        best = remembered(best_two(listed, floor))
        words = re.compile("[A-Za-z][A-Za-z'-]*")

        def option(word: str) -> str | None:
            value, score, _ = best(word)
            return value if score >= floor else None

        def line(text: str) -> list[str]:
            near = [option(w.lower()) for w in words.findall(text)]
            return [f"{a} {b}" for a, b in zip(near, near[1:]) if a is not None and b is not None]

        for texts in batches:
            yield texts.map(lambda text: None if text is None else [x for part in text.split("\n") for x in line(part)], na_action="ignore")

    return pairs


def window_scores(options: dict[str, str], floor: float):
    """UDF: for an array of word windows, the best score of every option in order.

    A task remembers the scores of its windows. An option is compared only with
    windows that have enough of its letters: shared letters bound the measure.
    """
    listed = list(options.values())

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        near = near_options(listed, floor)
        seen: dict[str, list[tuple[int, float]]] = {}

        def one(group):
            best = [0.0] * len(listed)
            for window in group:
                scores = seen.get(window)
                if scores is None:
                    scores = seen[window] = near(window)
                for i, found in scores:
                    best[i] = max(best[i], found)
            return best

        for groups in batches:
            if len(seen) > REMEMBERED:
                seen.clear()
            yield groups.map(one, na_action="ignore")

    return score


def near_options(listed: list[str], floor: float):
    """Function of a window: (number, score) of the options it may be near; options may be named to look at these alone."""
    ratio = make_ratio()
    letters = [Counter(key) for key in listed]

    def near(window: str, among: list[int] | None = None) -> list[tuple[int, float]]:
        held, out = Counter(window), []
        for i in range(len(listed)) if among is None else among:
            key = listed[i]
            needed = floor * (len(window) + len(key)) - 1e-9
            if 2 * min(len(window), len(key)) < needed:
                continue
            if 2 * sum(min(n, held[c]) for c, n in letters[i].items()) < needed:
                continue
            found = ratio(window, key, floor)
            if found > 0.0:
                out.append((i, found))
        return out

    return near


#: Texts whose words are looked at together.
_TEXTS = 2000


def text_windows(groups: list[list[str]], floor: float):
    """UDF: for words between single blanks, the best score of every option, those of each group in turn.

    The options of a group have as many words; they are compared with all runs
    of a word less to a word more, of a length that some option of the group
    can be near to. The letters that the words of a run share with an option,
    counted once for each distinct word, bound the measure: only runs within
    that bound are put together and scored, each distinct one once.
    """
    listed = [key for group in groups for key in group]
    length = np.array([len(key) for key in listed])
    blanks = np.array([key.count(" ") for key in listed])
    low, high, own = np.zeros(len(listed)), np.zeros(len(listed)), {}
    begin = 0
    for group in groups:
        size, lengths, places = len(group[0].split()), [len(key) for key in group], range(begin, begin + len(group))
        low[places], high[places] = min(lengths) * floor / (2 - floor), max(lengths) * (2 - floor) / floor
        for width in range(max(1, size - 1), size + 2):
            own.setdefault(width, []).extend(places)
        begin += len(group)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        near, letters = near_options(listed, floor), [Counter(key) for key in listed]
        seen: dict[tuple[str, int], float] = {}
        place: dict[str, int] = {}
        shared = np.zeros((1024, len(listed)), "int16")

        def number(word: str) -> int:
            nonlocal shared
            found = place.get(word)
            if found is None:
                found = place[word] = len(place)
                if found == len(shared):
                    shared = np.concatenate([shared, np.zeros_like(shared)])
                held = Counter(word)
                shared[found] = [sum(min(n, held[c]) for c, n in own.items() if c in held) for own in letters]
            return found

        def scored(window: str, option: int) -> float:
            pair = window, option
            if pair not in seen:
                found = near(window, [option])
                seen[pair] = found[0][1] if found else 0.0
            return seen[pair]

        def best_of(texts: list[str]) -> np.ndarray:
            best, split = np.zeros((len(texts), len(listed))), [[w for w in text.split(" ") if w] for text in texts]
            words = [w for text in split for w in text]
            owner = np.repeat(np.arange(len(texts)), [len(text) for text in split])
            codes = np.array([number(w) for w in words], dtype="int64")
            sizes = np.array([len(w) for w in words], dtype="int64")
            for width, options in own.items():
                runs = len(words) - width + 1
                if runs < 1:
                    continue
                size = sum(sizes[k : k + runs] for k in range(width)) + width - 1
                least, most = low[options].min(), high[options].max()
                at = np.flatnonzero((owner[:runs] == owner[width - 1 :]) & (size >= least) & (size <= most))
                size = size[at, None]
                held = sum(shared[codes[at + k]][:, options] for k in range(width)) + np.minimum(blanks[options], width - 1)
                needed = floor * (size + length[options]) - 1e-9
                fits = (2 * held >= needed) & (2 * np.minimum(size, length[options]) >= needed) & (size >= low[options]) & (size <= high[options])
                for run, option in zip(*np.nonzero(fits)):
                    first, option = at[run], options[option]
                    found = scored(" ".join(words[first : first + width]), option)
                    if found > best[owner[first], option]:
                        best[owner[first], option] = found
            return best

        for texts in batches:
            if len(seen) > REMEMBERED:
                seen.clear()
            if len(place) > REMEMBERED:
                place.clear()
            given, out = texts.tolist(), []
            for at in range(0, len(given), _TEXTS):
                part = given[at : at + _TEXTS]
                rows = iter(best_of([t for t in part if t is not None]).tolist())
                out += [None if t is None else next(rows) for t in part]
            yield pd.Series(out, dtype="object")

    return score


def best_windows(floor: float = 0.0):
    """UDF: for each target of an array, the best similarity over the runs of words of a text.

    Runs have a word less than the target to a word more, whatever its length.
    """

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        ratio = make_ratio()
        seen: dict[tuple[str, str], float] = {}

        def best(target: str | None, words: list[str], runs: dict[int, set[str]]) -> float | None:
            if target is None:
                return None
            size, letters, bounded = len(target.split(" ")), Counter(target), []
            for width in range(max(1, size - 1), size + 2):
                if width not in runs:
                    runs[width] = {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}
                for run in runs[width]:
                    both = len(target) + len(run)
                    bounded.append((2.0 * min(len(target), len(run)) / both if both else 1.0, run))
            # shared letters bound the measure as lengths do, so the best run is among those of the highest bounds
            bounded.sort(reverse=True)
            top = 0.0
            for bound, run in bounded:
                if bound <= top:
                    break
                pair = target, run
                if pair not in seen:
                    both = len(target) + len(run)
                    shared = 2.0 * sum(min(n, run.count(c)) for c, n in letters.items()) / both if both else 1.0
                    if shared <= top:
                        continue
                    seen[pair] = ratio(target, run, floor)
                top = max(top, seen[pair])
            return top

        for targets, texts in batches:
            if len(seen) > REMEMBERED:
                seen.clear()
            found = []
            for own, text in zip(targets, texts):
                words, runs = [] if text is None else text.split(" "), {}
                found.append(None if own is None or text is None else [best(target, words, runs) for target in own])
            yield pd.Series(found, dtype="object")

    return score


def first_word_like(target: str, floor: float):
    """UDF: which elements of an array start with a word near ``target``."""

    @F.pandas_udf(T.ArrayType(T.BooleanType()))
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ratio = make_ratio()
        near = remembered(lambda word: ratio(word, target, floor) >= floor)
        for groups in batches:
            yield groups.map(lambda group: None if group is None else [near(span.split(" ", 1)[0].lower()) for span in group], na_action="ignore")

    return hits
