"""The pipeline against a plain version of each stage, run on what the stage before it kept."""

import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from evidentia.llm import mixing, neardup, queries
from evidentia.llm.common import columns, stored
from test_mixing_quality_secrets import plain_spans
from test_pairs import plain_components

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    # planted rows: copies, near copies, secrets, junk without a letter
    planted = [
        (9001, "token = 0123456789abcdef01234567 " + " ".join(f"the{i} of" for i in range(40)), "en", "src1", 1),
        (9002, "", "en", "src1", 0),
        (9003, "12345 67890 !!!", "en", "src1", 0),
        (9004, None, None, None, None),
    ]
    docs = docs.union(spark.createDataFrame(planted, docs.schema)).union(docs.limit(20).withColumn("doc_id", F.col("doc_id") + 20_000))
    out = [("documents", stored(docs))]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, stored(stage(spark, out[-1][1], FOLDER))))
    return dict(out)


def rows_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "secret_scan", "mix_sources", "sentencepiece"]


def test_language_stage_drops_only_what_it_rejects(stages):
    before, after = dict(rows_of(stages["documents"])), dict(rows_of(stages["language_id"]))
    assert stages["language_id"].columns == stages["documents"].columns
    gone = before.keys() - after.keys()
    assert {9002, 9003, 9004} <= gone and len(gone) < 0.05 * len(before)
    assert all(before[i] == t for i, t in after.items())


def test_one_of_each_group_stays(stages):
    before = rows_of(stages["language_id"])
    want = {i for i, (_, c) in plain_components(before).items() if i == c}
    assert {i for i, _ in rows_of(stages["near_duplicates"])} == want and len(want) < len(before) - 15


def test_secrets_are_masked_and_nothing_else(stages):
    before, after = dict(rows_of(stages["near_duplicates"])), dict(rows_of(stages["secret_scan"]))
    assert before.keys() == after.keys() and 9001 in after
    for i, text in before.items():
        assert (after[i] == text) == (plain_spans(text) == "")
        assert plain_spans(after[i]) == "" or "[SECRET]" in after[i]
    assert not re.search("[0-9a-f]{24}", after[9001])


def test_copies_are_those_of_the_plain_distribution(stages, spark):
    docs = stages["secret_scan"]
    rates = {r["source"]: r["rate"] for r in mixing.repetition_rates(docs, mixing.tempered_weights(docs)).collect()}
    import hashlib
    import math

    want = Counter()
    for r in docs.collect():
        u = int(hashlib.md5(f"17:count:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        k, mass = 0, math.exp(-rates[r["source"]])
        total = mass
        while total < u:
            k, mass = k + 1, mass * rates[r["source"]] / (k + 1)
            total += mass
        if k:
            want[r["doc_id"]] = k
    assert Counter(i for i, _ in rows_of(stages["mix_sources"])) == want


def test_ids_are_the_library_s(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = dict(rows_of(stages["mix_sources"]))
    rows = stages["sentencepiece"].collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in rows_of(stages["mix_sources"]))
    for r in rows:
        want = library.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["decoded"] == library.decode(want)


def test_stages_take_odd_and_no_documents(spark, odd_documents, no_documents):
    for frame in (odd_documents, no_documents):
        docs = stored(frame.withColumns({"rejected": F.lit("r"), "lang_pred": F.lit(3), "mix_key": F.lit("m"), "Cross_entropy": F.lit(1)}))
        own = docs.columns
        extra = [c for c in own if c not in ("doc_id", "text", "lang", "source", "n_chars")]
        values = [str(r) for r in docs.select(*columns(docs, "doc_id", "text", "lang", "source", "n_chars")).distinct().collect()]
        assert len(extra) in (4, 12)
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, FOLDER))
            if name != "sentencepiece":
                assert docs.columns == own
                kept = docs.select(*columns(docs, "doc_id", "text", "lang", "source", "n_chars")).distinct().collect()
                assert all(str(r) in values for r in kept)


@pytest.mark.parametrize("name", ["op1_near_duplicates", "op2_secret_scan", "op3_mix_sources", "op6_quality_rules"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    frame = queries.catalog.queries[name](spark, FOLDER)
    columns = sorted(frame.columns)
    want = con.execute(f"select {', '.join(columns)} from ({queries.catalog.checks[name]})").fetchall()
    assert sorted(map(str, map(tuple, frame.select(columns).collect()))) == sorted(map(str, want))


def test_every_query_returns_one_row_per_document(spark):
    total = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for name in ("op1_near_duplicates", "op2_secret_scan", "op4_sentencepiece", "op5_token_files", "op6_quality_rules", "op7_repeated_passages", "op8_language_id", "op10_token_counts"):
        assert queries.catalog.queries[name](spark, FOLDER).count() == total, name


def test_near_duplicates_at_four_fifths(spark):
    def pair(i, size, places):
        words = [f"w{i}x{k}" for k in range(size)]
        return [(i, " ".join(words)), (i + 1, " ".join("other" if k in places else w for k, w in enumerate(words)))]

    rows = pair(1, 50, {25})  # 41 of 51 shingles
    rows += pair(11, 45, {22})  # 36 of 46: below the threshold
    rows += pair(21, 1000, set(range(20, 1000, 49)))  # cut sketches, 896 of 1096
    rows += pair(31, 1000, set(range(20, 1000, 38)))  # 866 of 1126: below
    want = {i for i, (_, c) in plain_components(rows, percent=80).items() if i == c}
    assert want == {1, 11, 12, 21, 31, 32}
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {i for i, _ in rows_of(neardup.one_of_each(docs, neardup.Links(percent=80)))} == want


def test_required_overlap_follows_the_threshold():
    assert [neardup.Links(percent=p).overlap for p in (80, 85)] == [71, 80]
