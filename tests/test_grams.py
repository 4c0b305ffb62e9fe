"""n-grams counted per key within tasks, against a plain count."""

from collections import Counter

import pyarrow as pa
import pytest

from evidentia.functions import grams
from evidentia.operators import textmodel as tm
from evidentia.plans.catalog import model
from evidentia.session import durable


def plain(texts, sizes):
    out = Counter()
    for text in texts:
        for word in filter(None, text.split(" ")):
            p = f" {word} "
            out.update(p[i : i + n] for n in sizes for i in range(len(p) - n + 1))
    return out


WIDE = " ".join("".join(chr(0x4E00 + (i * 37 + j * 7919) % 20000) for j in range(9)) for i in range(900))
ROWS = [
    ("a", "one two two"), ("a", "two"), ("b", ""), ("c", "a b \x00 nul\x00l"), (None, "x"), (None, "x yz"),
    ("d", "verylongwordwithoutanyspace " * 9 + "end"), ("e", "żółć 😀😀 ß"), ("f", WIDE),
]


@pytest.mark.parametrize("chunk", [3, 17, 400, 1 << 20])
@pytest.mark.parametrize("cut", [1, 2, 5, 20])
def test_chunks_and_batches_add_up(chunk, cut):
    for sizes in ((3, 4, 5), (2, 3, 4, 5, 6)):
        rows = ROWS[:8] if chunk < 400 else ROWS
        first = [i == 0 or rows[i - 1][0] != k for i, (k, _) in enumerate(rows)]
        table = pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows]), pa.array(first), pa.array([t for _, t in rows])], ["k", "first", "text"])
        got = Counter()
        for b in grams.counter(sizes, chunk)(table.slice(i, cut) for i in range(0, len(rows), cut)):
            for r in b.to_pylist():
                assert (r["k"], r["token"]) not in got
                got[r["k"], r["token"]] = r["tf"]
        keys = dict.fromkeys(k for k, _ in rows)
        want = {(k, t): n for k in keys for t, n in plain([x for y, x in rows if y == k], sizes).items()}
        assert got == want


def test_no_ngram_is_shuffled(spark):
    texts = spark.createDataFrame([(1, "Ab 12"), (1, "ab"), (2, None), (3, "c")], "id int, text string").repartition(3, "id")
    counted = tm.term_counts(texts, ["id"])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate" not in plan
    got = {(r.id, r.token): r.tf for r in counted.collect()}
    assert got[1, " ab "] == 2 and got[1, " ##"] == 1 and got[3, " c "] == 1 and {k for k, _ in got} == {1, 3}


def test_share_model_stores_no_counts_of_documents(spark, monkeypatch):
    stored = []
    for module in (tm, model):
        monkeypatch.setattr(module, "durable", lambda df: stored.append(df.columns) or durable(df))
    assert model.share_model(spark, "/root/testdata/sf0.001").weights.count()
    assert stored and not any("doc_id" in columns for columns in stored)
