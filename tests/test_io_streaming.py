"""Files, keys, models on disk and the incremental run."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evidentia import policy as fixed, schemas
from evidentia.operators import evaluate, merge, rank, sweep, textmodel as tm
from evidentia.plans import adjudicate as plan
from evidentia.sources import readers, sinks
from evidentia.sources.tracefiles import TraceWriter
from evidentia.streaming import incremental


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_records_roundtrip(spark, tmp_path):
    row = {"case_id": "b", **fixed.SENTINELS, "adjudication": "DENIED", "confidence": 0.5}
    path = write(tmp_path / "p.jsonl", "\n".join([json.dumps(row), "", json.dumps({**row, "case_id": "a"})]) + "\n")
    records = readers.read_records(spark, path)
    sinks.write_records(records, str(tmp_path / "out"))
    again = spark.read.schema(schemas.RECORDS).json(str(tmp_path / "out"))
    assert sorted(r.case_id for r in again.collect()) == ["a", "b"]
    assert again.exceptAll(records.select(*again.columns)).count() == 0


@pytest.mark.parametrize("lines, message", [
    (['{"case_id": "a"}', '{"case_id": "a"}'], "duplicate"),
    (['{"case_id": 5}'], "without a string"),
    (['{"other": "a"}'], "without a string"),
])
def test_record_keys_are_checked(spark, tmp_path, lines, message):
    path = write(tmp_path / "bad.jsonl", "\n".join(lines))
    with pytest.raises(ValueError, match=message):
        readers.read_records(spark, path)


def test_keys_are_checked_by_the_plan(spark, tmp_path):
    def rows(*lines):
        return readers.read_records(spark, write(tmp_path / "r.jsonl", "\n".join(lines)), in_plan=True)

    good = rows('{"case_id": "a"}', "", '{"case_id": "b"}')
    plan = good._jdf.queryExecution().executedPlan().toString()  # before it runs, so without a second, final plan
    assert sorted(r.case_id for r in good.collect()) == ["a", "b"]
    assert plan.count("Scan text") == 1 and "__place" not in good.columns
    for lines, message in (
        (['{"case_id": "a"}'] * 2, "duplicate case_id value: a"),
        (['{"case_id": 5}'], "without a string case_id"),
        (['{"case_id": ""}', '{"case_id": "a"}'], "without a string case_id"),
        (['{"other": "a"}'], "without a string case_id"),
    ):
        with pytest.raises(Exception, match=message):
            rows(*lines).count()  # also when no column is asked for
    assert readers.read_case_texts(spark, write(tmp_path / "none.jsonl", ""), in_plan=True).count() == 0


def test_strict_join(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "case_id string, v int")
    known = spark.createDataFrame([("a", "x"), ("b", None), ("c", "z")], "case_id string, w string")
    got = evaluate.strict_join(rows, known)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == [("a", 1, "x"), ("a", 2, "x"), ("b", 3, None)]
    for key in ("d", None):
        more = rows.union(spark.createDataFrame([(key, 4)], rows.schema))
        with pytest.raises(Exception, match=f"no row for case_id {key or 'null'}"):
            evaluate.strict_join(more, known).count()


def _traces(spark, *cases):
    return spark.createDataFrame([(c, [], []) for c in cases], schemas.TRACE)


def test_a_trace_file_per_case(spark, tmp_path):
    cases = ["a", "b/../c", ".hidden", "_x", "é 100%", "long" * 80]
    folder = tmp_path / "out"
    assert not sinks.write_traces(_traces(spark, *cases), None) and not folder.exists()
    assert sinks.write_traces(_traces(spark, *cases), str(folder))
    assert len(list(folder.rglob("*.trace.json"))) == len(cases)
    assert sorted(r.case_id for r in readers.read_traces(spark, str(folder)).collect()) == sorted(cases)
    # in place of the earlier run
    assert sinks.write_traces(_traces(spark, "a", "z"), f"file:{folder}")
    assert sorted(r.case_id for r in readers.read_traces(spark, str(folder)).collect()) == ["a", "z"]
    for bad, message in ((("q", "q"), "two traces of case q"), (("q", None), "without a case_id"), (("",), "without a case_id")):
        with pytest.raises(Exception, match=message):
            sinks.write_traces(_traces(spark, *bad), str(folder))
        assert not list(folder.glob(".run-*"))
    assert sorted(r.case_id for r in readers.read_traces(spark, str(folder)).collect()) == ["a", "z"]
    assert sinks.write_traces(_traces(spark), str(folder))
    assert readers.read_traces(spark, str(folder)).count() == 0


def test_repeated_attempts_of_a_task_do_not_mix(tmp_path):
    writer = TraceWriter(str(tmp_path / "out"), overwrite=False)
    batch = pa.RecordBatch.from_pydict({"case_id": ["a", "b"], "trace": ["{}", "{}"]})
    first, second = writer.write(iter([batch])), writer.write(iter([batch]))
    writer.commit([second, None])
    assert first.folder != second.folder
    assert len(list((tmp_path / "out").rglob("*.trace.json"))) == 2


def test_group_map(spark, tmp_path):
    good = readers.read_groups(spark, write(tmp_path / "g.json", '{"a": "g1",\n "b": "g2"}'))
    assert {(r.case_id, r.grp) for r in good.collect()} == {("a", "g1"), ("b", "g2")}
    for bad in ('["a"]', '{"a": 1}'):
        with pytest.raises(ValueError):
            readers.read_groups(spark, write(tmp_path / "bad.json", bad))


def test_model_on_disk(spark, tmp_path):
    weights = spark.createDataFrame([("abc", 1.5, [2.0])], tm.WEIGHTS)
    model = tm.Model(weights, (0.25,), 10, threshold=0.5)
    folder = str(tmp_path / "model")
    sinks.save_model(model, folder, "denial/v1")
    loaded = readers.read_model(spark, folder, "denial/v1")
    assert loaded.intercepts == (0.25,) and loaded.threshold == 0.5
    assert loaded.weights.collect() == weights.collect()
    assert readers.read_model(spark, folder, "denial/v2") is None
    assert readers.read_model(spark, str(tmp_path / "none"), "denial/v1") is None
    with pytest.raises(RuntimeError):
        sinks.save_model(model, folder, "denial/v1", error=1e-3)


def test_page_reader_keeps_failed_documents(spark, tmp_path):
    write(tmp_path / "good.pdf", "one|one|two\fthree")
    write(tmp_path / "bad.pdf", "first\fBROKEN")

    def read_pages(content):
        for page in content.decode().split("\f"):
            if page == "BROKEN":
                raise RuntimeError("unreadable page")
            yield page.split("|")

    rows = readers.page_readings(readers.scan_documents(spark, str(tmp_path)), read_pages).collect()
    got = {(r.case_id, r.page, r.reading_no): r.text for r in rows if r.error is None}
    assert got == {("good", 1, 0): "one", ("good", 1, 1): "two", ("good", 2, 0): "three", ("bad", 1, 0): "first"}
    assert [r.error for r in rows if r.error] == ["RuntimeError: unreadable page"]


def test_stream_equals_batch(spark, tmp_path):
    pages = [
        ("A", 1, 0, "native", "Visa Class: MED-3\nFee Status: paid"),
        ("B", 1, 0, "native", "Finding: DENIED"),
        ("A", 2, 0, "native", "Finding: NEEDS REVIEW"),
    ]
    arrivals, store, records, mark = (str(tmp_path / n) for n in ("in", "store", "records", "mark"))
    for part in (pages[:2], pages[2:]):
        # a late page reopens its case only
        spark.createDataFrame(part, schemas.READINGS).coalesce(1).write.mode("append").parquet(arrivals)
        query = incremental.adjudicate_arrivals(spark, arrivals, store, records, mark)
        assert query.awaitTermination(240)
    versions = spark.read.parquet(records)
    assert versions.count() == 3
    latest = incremental.latest_records(versions)
    batch = plan.adjudicate(spark.createDataFrame(pages, schemas.READINGS))
    assert sorted(map(tuple, latest.collect())) == sorted(map(tuple, batch.collect()))


def test_merge_rerun(spark):
    full = spark.createDataFrame([("a", 1), ("b", 1)], "case_id string, v int")
    rerun = spark.createDataFrame([("b", 2)], "case_id string, v int")
    assert sorted(map(tuple, merge.merge_rerun(full, rerun).collect())) == [("a", 1), ("b", 2)]


def test_running_sums_against_brute_force(spark):
    rows = [(float((i * 37) % 50), 1) for i in range(400)] + [(7.0, 1)] * 200
    histogram = spark.createDataFrame(rows, "s double, n int").groupBy("s").agg(F.sum("n").alias("n"))
    got = {r.s: r.cum_n for r in rank.running_sums(histogram, "s", ["n"], descending=True, ranges=8).collect()}
    assert got == {s: sum(n for t, n in rows if t >= s) for s, _ in rows}


def test_coordinate_thresholds(spark):
    rows = [("none", "x" if i % 2 else "none", i % 2 * 0, 0.7 if i % 2 else 0.5, 0.1) for i in range(40)]
    df = spark.createDataFrame(rows, "current string, actual string, half int, p_x double, p_y double")
    chosen, measured = sweep.coordinate_thresholds(df, ("x", "y"), (0.45, 0.55, 0.65, 0.75), "half")
    assert chosen["x"] == 0.55 and measured == {"gains": 20, "losses": 0, "net": 20}
