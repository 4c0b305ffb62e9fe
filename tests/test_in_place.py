"""n-grams counted in place: the same sums and vectors as by plain counting, without a row of a token that moves."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evidentia.functions import grams, text as tx
from evidentia.operators import jointfit, textmodel as tm

LETTERS = "abcdeéΩ漢😀#"


def plain(texts):
    found = Counter()
    for word in " ".join(t or "" for t in texts).split(" "):
        padded = f" {word} "
        found.update(padded[k : k + n] for n in (3, 4, 5) for k in range(len(padded) - n + 1) if word)
    return found


@pytest.fixture(scope="module")
def keyed():
    chance = random.Random(1)
    word = lambda: "".join(chance.choice(LETTERS) for _ in range(chance.randint(1, 7)))
    keys = [[" ".join(word() for _ in range(chance.randint(0, 30))) for _ in range(chance.randint(1, 4))] for _ in range(120)]
    keys[7], keys[50] = ["", None], [" ".join(["abcd"] * 900)] * 3
    return keys


def batches(keyed, number):
    rows = [(number(k), i == 0, t) for k, texts in enumerate(keyed) for i, t in enumerate(texts)]
    for at in range(0, len(rows), 17):
        columns = zip(*rows[at : at + 17])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.bool_(), pa.string()))], ["own", "first", "text"])


@pytest.mark.parametrize("chunk", [300, 2000, 1 << 20])
@pytest.mark.parametrize("words", [False, True])
def test_sums_and_vectors_equal_plain_counts(keyed, chunk, words):
    sizes = (1, 2) if words else (3, 4, 5)
    counts = [grams.words_of([t or "" for t in texts], sizes) if words else plain(texts) for texts in keyed]
    want, got = Counter(), Counter()
    for k, found in enumerate(counts):
        for token, n in found.items():
            want[token, k % 3, "df"] += 1
            want[token, k % 3, "cf"] += n
    for batch in grams.profiler(sizes, words, chunk)(batches(keyed, lambda k: k % 3)):
        for token, fold, df, cf in zip(*(c.to_pylist() for c in batch.columns)):
            got[token, fold, "df"] += df
            got[token, fold, "cf"] += cf
    assert got == want
    tokens = sorted({t for t, _, _ in want})[::7] + ["a b c", "x  "]
    find = (grams.WordFinder if words else grams.Finder)(tokens, sizes)
    seen = 0
    for held, ends, place, n in grams.vectors(batches(keyed, lambda k: k), find, chunk):
        begin = 0
        for (k,), end in zip(held, ends):
            assert {tokens[p]: c for p, c in zip(place[begin:end], n[begin:end])} == {t: counts[k][t] for t in tokens if t in counts[k]}
            begin, seen = end, seen + 1
    assert seen == len(keyed)


def frame(spark):
    rows = [(i, "good words here 12" if i % 2 else "bad Phrases\n there", i % 2 == 0 or i % 7 == 0) for i in range(60)] + [(70, None, True), (71, "", False)]
    return spark.createDataFrame(rows, "id int, text string, y boolean")


def test_fit_in_place_equals_that_of_counts_also_for_repeated_keys(spark):
    df = frame(spark)
    rows = df.unionByName(df.filter("id < 5")).select("id", "y")
    fits = []
    for counts in (tm.Grams(df.select("id", "text"), ["id"]), tm.term_counts(df.select("id", "text"), ["id"])):
        packed = jointfit.pack(counts, rows, "id", {"y": F.col("y")}, 2, 40, "y", 3)
        assert packed.blocks.isCheckpointed() and packed.blocks.count() > 0
        fits.append(sorted(map(tuple, jointfit.fit(packed, {"y": ("y", 2.0, True)}).probabilities().collect())))
    assert len(fits[0]) == rows.count()
    assert np.allclose(fits[0], fits[1], atol=1e-5)


def test_scores_and_weights_in_place_move_no_token(spark):
    df = frame(spark).select("id", "text")
    packed = jointfit.pack(tm.Grams(df, ["id"]), frame(spark), "id", {"y": F.col("y")}, 2, 40)
    model = jointfit.fit(packed, {"y": ("y", 2.0, True)}).model(("y",), 40)
    near = tm.raw_scores(df, ["id"], {"m": model})
    shown = near.sparkSession._jvm.PythonSQLUtils.explainString(near._jdf.queryExecution(), "simple")
    assert "Join" not in shown and "Generate" not in shown
    vocab = tm.vocabulary(tm.Grams(df, ["id"]), 62, 2, 40)
    here = {(r["id"], r["token"]): r["weight"] for r in tm.tfidf(tm.Grams(df, ["id"]), vocab, ["id"]).collect()}
    there = {(r["id"], r["token"]): r["weight"] for r in tm.tfidf(tm.term_counts(df, ["id"]), vocab, ["id"]).collect()}
    assert here.keys() == there.keys() and all(abs(here[k] - there[k]) < 1e-12 for k in here)
    proofs = [jointfit.stationarity(c, frame(spark).filter("id < 70").withColumn("y", F.col("y").cast("int")), "id", "y", model, 2.0).collect()[0] for c in (tm.Grams(df, ["id"]), tm.term_counts(df, ["id"]))]
    assert all(proofs[0][n] == proofs[1][n] for n in ("rows", "positives", "tokens")) and abs(proofs[0]["largest"] - proofs[1]["largest"]) < 1e-9


def test_masked_texts_keep_single_blanks(values):
    texts = ["a\n\nb  c\t d\x1f\x85e　f ", None, "", " é\n 1٣ \x0b", "x\r\n y ", " \n"]
    plain_mask = lambda c: tx.normalize_space(F.regexp_replace(tx.casefold(c), r"(?U)\d", "#"))
    assert values(tx.mask_digits, texts) == values(plain_mask, texts)
