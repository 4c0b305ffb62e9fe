"""Near words and windows: the same scores as by comparing all, each distinct string once a task."""

import random
from difflib import SequenceMatcher

import pandas as pd
import pytest

from evidentia.functions import similarity


@pytest.fixture
def asked(monkeypatch):
    found, plain = [], similarity.make_ratio

    def make():
        ratio = plain()
        return lambda a, b, floor=0.0: found.append((a, b)) or ratio(a, b, floor)

    monkeypatch.setattr(similarity, "make_ratio", make)
    return found


def words(chance, n):
    return " ".join("".join(chance.choice("abcdlnu") for _ in range(chance.randint(1, 7))) for _ in range(n))


def test_windows_of_texts_are_bounded_before_they_are_put_together(asked):
    chance = random.Random(3)
    groups, floor = [["luna", "duna b"[:4], "abcd"], ["bad luna", "alb ndu"]], 0.7
    texts = [words(chance, chance.randint(0, 25)) for _ in range(60)] + ["", "luna", "x lunal bad luna"]
    listed = [k for g in groups for k in g]

    def plain(text):
        own, best = text.split(), [0.0] * len(listed)
        for i, key in enumerate(listed):
            size = len(key.split())
            for width in range(max(1, size - 1), size + 2):
                for at in range(len(own) - width + 1):
                    window = " ".join(own[at : at + width])
                    matcher = SequenceMatcher(None, window, key)
                    if 2 * min(len(window), len(key)) >= floor * (len(window) + len(key)) - 1e-9 and matcher.quick_ratio() >= floor:
                        best[i] = max(best[i], matcher.ratio())
        return best

    score = similarity.text_windows(groups, floor).func
    found = [list(b) for b in score(iter([pd.Series([*texts, None]), pd.Series(texts)]))]
    assert found[0] == [*map(plain, texts), None] and found[1] == found[0][:-1]
    assert 0 < len(asked) == len(set(asked))


def test_best_windows_compare_few_runs(asked):
    chance = random.Random(5)
    texts = [words(chance, 20) for _ in range(30)] + [""]
    targets = [[words(chance, 2), None, words(chance, 1)] for _ in texts]

    def plain(target, text):
        own, size = text.split(" "), len(target.split(" "))
        runs = [" ".join(own[i : i + w]) for w in range(max(1, size - 1), size + 2) for i in range(len(own) - w + 1)]
        return max([0.0, *(SequenceMatcher(None, target, run).ratio() for run in runs)])

    score = similarity.best_windows().func
    found = list(next(iter(score(iter([(pd.Series([*targets, None]), pd.Series([*texts, "a"]))])))))
    assert found == [*([None if t is None else plain(t, x) for t in own] for own, x in zip(targets, texts)), None]
    assert len(asked) < 31 * 2 * 40 / 2  # all of them are about forty for each target


def test_near_pairs_score_each_word_once(asked):
    names = {"Luna": "luna", "Bado": "bado"}
    pairs = similarity.near_pairs(names, 0.7).func
    texts = ["Lunna BADO x luna\nbado Luma, Bad'o\n", "bado\nluna", None]
    found = [list(b) for b in pairs(iter([pd.Series(texts), pd.Series(texts[:1])]))]
    assert found[0] == [["Luna Bado", "Bado Luna", "Luna Bado"], [], None] and found[1] == [found[0][0]]
    assert len(asked) == len(set(asked))


def test_near_values_are_remembered_across_batches(asked):
    match = similarity.nearest_each({"paid": "paid", "unpaid": "unpaid"}, 0.6).func
    batches = [pd.Series([["pald", "x"], None]), pd.Series([["pald"]])]
    found = [list(b) for b in match(iter(batches))]
    assert found[0][0][0]["value"] == "paid" and found[0][1] is None and found[1][0][0] == found[0][0][0]
    assert len(asked) == len(set(asked))
