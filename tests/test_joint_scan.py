"""Joint fits, scorer, indexed near values, scans and the registry without its optional part."""

import os
import random
import shutil
import subprocess
import sys
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidentia.operators import jointfit, scan, snap, textmodel as tm
from evidentia.sources import vocab

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def texts(spark):
    draw = random.Random(3)
    words = ["paid", "fee", "denied", "world", "visa", "note", "zarn", "kesh", "ruled", "open"]
    rows = [(i, " ".join(draw.choice(words[: 10 if i % 3 else 6]) for _ in range(draw.randint(1, 12))), i % 3 == 0, i % 4 == 1) for i in range(120)]
    rows += [(500, "", True, False), (501, None, False, None)]
    df = spark.createDataFrame(rows, "id int, text string, a boolean, b boolean")
    return df, tm.term_counts(df.select("id", "text"), ["id"])


def plain_matrix(rows, min_df, most, train):
    """TF-IDF of (id, text) over the vocabulary of the rows in ``train``."""
    counts = {}
    for i, text in rows:
        c = counts[i] = {}
        for w in (text or "").split():
            p = f" {w} "
            for n in (3, 4, 5):
                for k in range(len(p) - n + 1):
                    c[p[k : k + n]] = c.get(p[k : k + n], 0) + 1
    df, cf = {}, {}
    for i in train:
        for t, n in counts[i].items():
            df[t], cf[t] = df.get(t, 0) + 1, cf.get(t, 0) + n
    kept = sorted(sorted((t for t in df if df[t] >= min_df), key=lambda t: (-cf[t], t))[:most])
    idf = np.array([np.log((1 + len(train)) / (1 + df[t])) + 1 for t in kept])
    x = np.zeros((len(rows), len(kept)))
    for r, (i, _) in enumerate(rows):
        for j, t in enumerate(kept):
            if t in counts[i]:
                x[r, j] = (1 + np.log(counts[i][t])) * idf[j]
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return kept, x / np.where(norm > 0, norm, 1)


def plain_fit(x, y, c, balance):
    """Newton's method on the objective, the intercept one more feature."""
    x1 = np.column_stack([x, np.ones(len(x))])
    size = np.array([(~y).sum(), y.sum()])
    amount = c * (len(y) / (2 * size))[y.astype(int)] if balance else np.full(len(y), c)
    w = np.zeros(x1.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x1 @ w))
        gradient = w + x1.T @ (amount * (p - y))
        hessian = np.eye(len(w)) + x1.T @ (x1 * (amount * p * (1 - p))[:, None])
        w = w - np.linalg.solve(hessian, gradient)
    return w


def test_joint_fit_equals_newton_for_every_target_and_fold(spark, texts):
    df, counts = texts
    packed = jointfit.pack(counts, df, "id", {"a": F.col("a"), "b": F.col("b")}, 2, 60, "a", 3)
    fitted = jointfit.fit(packed, {"a": ("a", 2.0, True), "b": ("b", 8.0, False)}, tolerance=1e-9)
    got = {r["id"]: r for r in fitted.probabilities().collect()}
    rows = [(r["id"], r["text"]) for r in df.collect()]
    label = {r["id"]: (bool(r["a"]), bool(r["b"])) for r in df.collect()}
    assert set(got) == set(label)
    for fold in range(3):
        train = [i for i in label if got[i]["fold"] != fold]
        kept, x = plain_matrix(rows, 2, 60, train)
        assert [t for t, v in zip(packed.tokens, packed.spaces[fold].idf) if v > 0] == kept
        at = [k for k, (i, _) in enumerate(rows) if i in set(train)]
        for n, (name, c, balance) in enumerate((("a", 2.0, True), ("b", 8.0, False))):
            y = np.array([label[rows[k][0]][n] for k in at])
            w = plain_fit(x[at], y, c, balance)
            for k, (i, _) in enumerate(rows):
                if got[i]["fold"] == fold:
                    assert abs(got[i][name] - 1 / (1 + np.exp(-(x[k] @ w[:-1] + w[-1])))) < 1e-6


def test_exported_model_is_certified_and_a_wrong_one_is_not(spark, texts):
    df, counts = texts
    packed = jointfit.pack(counts, df, "id", {"a": F.col("a")}, 2, 60)
    fitted = jointfit.fit(packed, {"a": ("a", 2.0, True)}, tolerance=1e-8)
    model = fitted.model(("a",), 60)
    proof = jointfit.stationarity(counts, df, "id", "a", model, 2.0).collect()[0]
    assert proof["rows"] == 122 and proof["tokens"] == len(packed.tokens) and proof["largest"] < 1e-6
    wrong = tm.Model(model.weights, (model.intercepts[0] + 0.1,), 60)
    assert jointfit.stationarity(counts, df, "id", "a", wrong, 2.0).collect()[0]["largest"] > 1e-4


def test_scores_do_not_depend_on_the_broadcast_and_no_text_is_broadcast(spark, texts, monkeypatch):
    df, counts = texts
    model = jointfit.fit(jointfit.pack(counts, df, "id", {"a": F.col("a")}, 2, 60), {"a": ("a", 2.0, True)}).model(("a",), 60)

    def scores():
        rows = tm.raw_scores(df.select("id", "text"), ["id"], {"m": model, "n": model})
        plan = rows._jdf.queryExecution().executedPlan().toString()
        for part in plan.split("BroadcastExchange")[1:]:
            below = []
            depth = len(part) and part.splitlines()[1:2]
            for line in part.splitlines()[1:]:
                if depth and line.find("+-") >= 0 and line.find("+-") < depth[0].find("+-"):
                    break
                below.append(line)
            assert not any("Generate" in line and "text" in line for line in below)
        return {r["id"]: r["m"][0] for r in rows.collect()}

    near = scores()
    monkeypatch.setattr(tm, "BROADCAST_ROWS", 0)
    far = scores()
    assert near.keys() == far.keys() and all(abs(near[i] - far[i]) < 1e-12 for i in near)


def test_most_frequent_rows_with_ties(spark):
    draw = random.Random(1)
    rows = [(f"t{i}", draw.choice([1, 1, 2, 5, 70, 71, 5000])) for i in range(400)]
    df = spark.createDataFrame(rows, "token string, cf long")
    for k in (1, 50, 399, 1000):
        got = [(r["token"], r["cf"]) for r in tm.most_frequent(df, k).collect()]
        assert sorted(got) == sorted(sorted(rows, key=lambda r: (-r[1], r[0]))[:k])


@pytest.mark.parametrize("least", [0.6, 0.8, 0.86])
def test_indexed_near_values_equal_the_scan(spark, least):
    draw = random.Random(7)
    options = ["".join(draw.choice("abcde") for _ in range(draw.randint(1, 9))) for _ in range(120)]
    needles = [*options[:20], *("".join(draw.choice("abcdef") for _ in range(draw.randint(1, 9))) for _ in range(120)), ""]
    frame = lambda values: spark.createDataFrame([(v,) for v in values], "key string")
    got = {(r["key"], r["option_key"]): r["score"] for r in snap.near(frame(needles), frame(options), least).collect()}
    want = {}
    for a in set(needles) - {""}:
        for b in set(options):
            score = SequenceMatcher(None, a, b).ratio()
            if score >= least - 1e-9:
                want[a, b] = score
    assert got.keys() == want.keys() and len(want) > 20
    assert all(abs(got[p] - s) < 1e-12 for p, s in want.items())


def test_vocabulary_is_written_loaded_and_fails_soft(spark, tmp_path):
    values = spark.createDataFrame([("f", "b"), ("f", "a"), ("g", "x y"), ("f", "a")], "field string, value string")
    vocab.write_vocabulary(values, str(tmp_path / "v"))
    assert sorted(map(tuple, vocab.load_vocabulary(spark, str(tmp_path / "v")).collect())) == [("f", "a"), ("f", "b"), ("g", "x y")]
    for name, text in (("no", "{"), ("other", '{"schema": "else", "fields": {"f": ["a"]}}'), ("list", "[1]")):
        (tmp_path / name).write_text(text)
        assert vocab.load_vocabulary(spark, str(tmp_path / name)).count() == 0
    assert vocab.load_vocabulary(spark, str(tmp_path / "missing")).count() == 0


def test_unique_patterns_and_variants(spark):
    rows = [(1, "SPN-1234 spn 1234 2026-01-02"), (1, "seen 2026/01/02"), (2, "SPN-1111 and SPN 2222"), (3, None), (4, "2026-02-31")]
    df = spark.createDataFrame(rows, "case_id int, text string")
    got = {(r["case_id"], r["field"]): (r["value"], r["distinct"]) for r in scan.unique_patterns(df).collect()}
    assert got == {(1, "sponsor_id"): ("SPN-1234", 1), (1, "arrival_date"): ("2026-01-02", 1), (2, "sponsor_id"): ("", 2)}
    truth = spark.createDataFrame([(1, "active_warrant|sponsor_mismatch", "ALPHA_D"), (2, "none", "")], "case_id int, risk_flags string, species_code string")
    shown = spark.createDataFrame([(1, "Active-Warrant; alpha d"), (1, "sponsor mismatch"), (2, "none")], "case_id int, text string")
    found = {(r["case_id"], r["field"]): (r["variants"], r["readings"], r["found"]) for r in scan.value_alternatives(shown, truth, ["risk_flags", "species_code"]).collect()}
    assert found == {
        (1, "risk_flags"): ("active warrant sponsor mismatch|active warrant|sponsor mismatch", 1, 1),
        (1, "species_code"): ("alpha d", 1, 1),
        (2, "risk_flags"): ("none", 1, 1),
        (2, "species_code"): ("", 0, 0),
    }


def test_registry_works_without_the_optional_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda at, names: [n for n in names if n in (".git", "__pycache__") or (n == "llm" and os.path.basename(at) in ("evidentia", "tests"))])
    code = (
        "import __spark_entry__ as e; from evidentia.session import get_session; s = get_session('t', 'local[2]', 2); q = e.queries(); "
        "assert 'pipeline' not in q and not any(n.startswith('op1_') for n in q) and set(e.oracle_sql()) < set(q); "
        "print(q['stratified_folds'](s, '/root/testdata/sf0.001').count())"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0 and int(done.stdout.split()[-1]) > 0, done.stderr[-2000:]
