"""Plans whose cost grew faster than the input, or ran as code the JVM never compiles."""

from pyspark.sql import functions as F

from evidentia.functions import text as tx
from evidentia.operators import extract, regions
from evidentia.plans import bindings as src
from evidentia.plans.catalog import extract as queries

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_categories_fold_as_bit_sets(spark):
    found = queries.category_containment(spark, SMALL)
    assert "collect_set" not in plan(found) and "ObjectHashAggregate" not in plan(found)


def test_category_summary(spark):
    rows = spark.createDataFrame(
        [("a", "from Luna to Venus"), ("a", "Luna"), ("a", "no name"), ("b", "nothing"), ("c", "research on transit")], "case_id string, text string"
    )
    worlds, purposes = ("Venus", "Luna"), ("transit", "research")
    policy = extract.DEFAULT.__class__(home_worlds=worlds, purposes=purposes)
    words = rows.select("case_id", extract.padded(F.col("text")).alias("w"))
    masks = extract.category_masks(F.col("w"), F.lit("intake"), policy)
    found = extract.category_summary(words.select("case_id", *[m.alias(n) for n, m in masks.items()]), policy)
    assert {tuple(r) for r in found.collect()} == {
        ("a", "home_world", "Luna", 2, ""),
        ("c", "declared_purpose", "research", 2, ""),
    }


def test_words_of_approximate_applicants(spark):
    """The class of other characters is spelled out; edges of its ranges and letters beyond ASCII separate words."""
    texts = ["Appiant® Lunax Oriul", "Applicant@[`{Lunax~\x7fé😀Oriul", "Applicant Lun'ax Ori-ul", "Applicant Lunax\nOriul"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "case_id int, text string")
    found = {r.case_id: r.approximate for r in extract.approximate_applicants(rows, F.col("text")).collect()}
    assert found == {0: ["Lunax Oriul"], 1: ["Lunax Oriul"], 2: ["Lun'ax Ori-ul"], 3: []}


def test_long_projections_stay_out_of_whole_stage_code(spark):
    """Methods over 8000 bytes are never compiled by the JVM: the readings and their labels."""
    import re

    facts = extract.evidence(src.readings(spark, SMALL), fuzzy=False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (src.readings(spark, SMALL), facts):
            text = spark._jvm.PythonSQLUtils.explainString(df.select("*")._jdf.queryExecution(), "codegen")
            assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text))) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_window_scores_are_remembered_across_batches(spark, monkeypatch):
    """A window of a later batch is not scored again, and one without the letters of an option never is."""
    import pandas as pd

    from evidentia.functions import similarity

    asked, plain = [], similarity.make_ratio()

    def ratio(a, b, floor=0.0):
        asked.append((a, b))
        return plain(a, b, floor)

    monkeypatch.setattr(similarity, "make_ratio", lambda: ratio)
    score = similarity.window_scores({"Luna": "luna", "Venus": "venus"}, 0.75).func
    batches = [pd.Series([["luma", "xxxx"], None]), pd.Series([["luma", "venus"]])]
    found = [list(b) for b in score(iter(batches))]
    assert found == [[[0.75, 0.0], None], [[0.75, 1.0]]]
    assert asked == [("luma", "luna"), ("venus", "venus")]


def test_page_kind_is_compiled(spark):
    """No lambda: its markers would be looked up by interpreted code."""
    rows = spark.createDataFrame(
        [("Fee Receipt amount",), ("B-13",), ("registry",), ("fee status registry registered amount",), ("",), (None,)], "text string"
    )
    found = rows.select(extract.page_kind(F.col("text")).alias("kind"))
    assert "lambda" not in plan(found)
    assert [r.kind for r in found.collect()] == ["fee", "biometric", "other", "fee", "other", "other"]


def test_starts_of_words_are_looked_for_by_letter(spark):
    """The slow test for the start of a word runs only where a letter fits, in any case and script."""
    texts = ["Sponsor: Ann", "ſPONSOR: Bo", "éSponsor: no", "_sponsor: no", "-sponsor: Cy", "Rısk Flag: x", "Flag: y"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    found = rows.select("i", tx.label_inline(F.col("text"), "Sponsor").alias("s"), tx.label_inline(F.col("text"), "(?:Risk )?Flag").alias("f"))
    assert "(?=[Ssſ])" in plan(found)
    got = {r.i: r.s or r.f for r in found.collect()}
    assert got == {0: "Ann", 1: "Bo", 2: "", 3: "", 4: "Cy", 5: "x", 6: "y"}


def test_rows_of_plain_and_other_texts(values, spark):
    """ASCII texts take a shorter way to the same rows."""
    plain = " a  b\r\n\r\n c\td \x1c\x0be\x1f f \n "
    assert values(tx.rows_text, [plain, "é" + plain, "", "\n \t"]) == ["a b\nc d\ne f", "é a b\nc d\ne f", "", ""]
    shown = plan(spark.createDataFrame([("a",)], "text string").select(tx.rows_text(F.col("text"))))
    assert "octet_length" in shown


def test_lines_are_split_only_where_a_flag_is(values, spark):
    texts = ["barcode biohazard_red\nactive warrant", "no\nflag", "ignore identity-conflict", None]
    assert values(extract.adverse_flags, texts) == ["active_warrant", "", "", None]
    calm = ["Observed Flags: none", "risk  flags -- NONE", "flags observed none", "none", None]
    assert values(extract.clean_biometrics, calm) == [True, True, False, False, None]
    shown = plan(spark.createDataFrame([("a",)], "text string").select(extract.clean_biometrics(F.col("text")).alias("x")))
    assert shown.count("regexp_replace") == 1


def test_word_rows_are_split_once(spark):
    lines = ["1\t2\t3\t4\t5\t6\t7\t90\tword", "?\t2\t3\t4\t5\t6\t7\t90\tword", "1\t2", None]
    rows = spark.createDataFrame([(t,) for t in lines], "row string")
    found = regions.parse_word_rows(rows, "row")
    assert [(r.row, r.left, r.text) for r in found.collect()] == [(lines[0], 1, "word")]
    assert plan(found).count("split(") == 1
