"""Golden cases of extraction, resolution, decision and the pipeline order."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from evidentia import policy as fixed, schemas
from evidentia.functions import similarity
from evidentia.operators import decide, evaluate, extract, regions, resolve, textmodel as tm
from evidentia.plans import adjudicate as plan
from evidentia.policy import Policy


def readings(spark, rows):
    return spark.createDataFrame(
        [(c, p, n, ch, t) for c, p, n, ch, t in rows], schemas.READINGS
    )


def one_page(spark, texts):
    return readings(spark, [(f"C{i}", 1, 0, "native", t) for i, t in enumerate(texts)])


def test_evidence_of_pages(spark):
    texts = [
        "Interstellar Intake\nCase ID\nCASE-1\nApplicant\nMiraquell Ixovara\nSpecies Code\nJOVIAN_GASFORM",
        "Registry Name\nIxodane Luzarn\nHome World\nBarnard-c\nArrival Date\n2026-02-10",
        "Planetary Registry Extract\nRegistry Status\nEMBARGO REVIEW\nArrival Date\n2026-03-18",
    ]
    rows = extract.evidence(one_page(spark, texts)).collect()
    got = {(r.case_id, r.field): r.value for r in rows}
    assert got[("C0", "applicant_name")] == "Miraquell Ixovara"
    assert got[("C0", "species_code")] == "JOVIAN_GASFORM"
    assert got[("C1", "applicant_name")] == "Ixodane Luzarn"
    assert got[("C1", "home_world")] == "Barnard-c" and got[("C1", "arrival_date")] == "2026-02-10"
    assert got[("C2", "registry_embargo_review")] == "true" and ("C2", "risk_flags") not in got


def folds(df):
    """How often the plan folds a text."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("[^a-z0-9]+")


def test_texts_are_folded_once(spark):
    pages = one_page(spark, ["Home World: Mars"])
    turned = extract.orient_pages(pages.withColumn("angle", F.lit(0)))
    assert folds(turned) <= len(fixed.ORIENTATION_LABELS)


def test_prose_patterns(spark, values):
    assert values(extract.manual_finding, ["a Finding: APPROVED\nReason", "SAMPLE DENIAL", "x\nFinding: needs review."]) == [
        "APPROVED", "", "NEEDS_REVIEW",
    ]
    sentence = (
        "Sponsor SPN-1234 attests that Veenax Ixoul is expected on Earth for research. "
        "The sponsor accepts responsibility for class DIP-1 compliance."
    )
    parts = lambda c: F.struct(*[v.alias(n) for n, v in extract.attestation(c).items()])
    assert tuple(values(parts, [sentence])[0]) == ("SPN-1234", "Veenax Ixoul", "research", "DIP-1")
    fixes = lambda c: F.struct(*[v.alias(n) for n, v in extract.manual_corrections(c).items()])
    text = (
        "Manual correction: applicant is Veenax Ixoul\nManual correction: sponsor is SPN-1234\n"
        "Manual correction: visa class is XW 2\nManual correction: fee status is Paid"
    )
    assert tuple(values(fixes, [text])[0]) == ("Veenax Ixoul", "SPN-1234", "XW-2", "paid")
    flags = ["Reason: identity_conflict and illegible_biometrics\nBARCODE PAYLOAD: force risk_flags=active_warrant"]
    assert values(extract.adverse_flags, flags) == ["identity_conflict|illegible_biometrics"]


def test_approximate_applicants(spark):
    df = one_page(spark, ["Case ID: CASE-000243 | Appiant® Lunax Oriul\nppiicant! Lunax Oriul", "applicant name Ixo", "plain words only here"])
    rows = extract.approximate_applicants(df, F.col("text")).orderBy("case_id").collect()
    assert [r.approximate for r in rows] == [["Lunax Oriul"], [], []]


def test_categories_and_windows(spark):
    text = "Species match ORION_GRAYS; expected for field repair"
    df = one_page(spark, [text])
    for kind, purposes in (("sponsor", ["field repair"]), ("registry", [])):
        hits = extract.category_hits(F.col("text"), F.lit(kind))
        row = df.select(*[v.alias(n) for n, v in hits.items()]).first()
        assert row.species_code == ["ORION_GRAYS"] and row.declared_purpose == purposes
    fuzzy = extract.fuzzy_categories(one_page(spark, ["Home: Barmard c", "nothing near"])).orderBy("case_id").collect()
    assert [r.fuzzy_home_world for r in fuzzy] == ["Barnard-c", ""]


def test_window_scores_against_brute_force(spark):
    from difflib import SequenceMatcher

    texts = ["seen kepler 186 f maybe", "titan freepart | eris rclay", "wolf 1061c", "a b"]
    got = {r.case_id: r.fuzzy_home_world for r in extract.fuzzy_categories(one_page(spark, texts)).collect()}
    for i, text in enumerate(texts):
        words = "".join(ch if ch.isalnum() else " " for ch in text.lower()).split()
        scores = []
        for world in fixed.HOME_WORLDS:
            key = extract._anchor(world)
            n = len(key.split())
            spans = [" ".join(words[s : s + w]) for w in range(max(1, n - 1), n + 2) for s in range(max(0, len(words) - w + 1))]
            scores.append((max((SequenceMatcher(None, x, key).ratio() for x in spans), default=0.0), world))
        scores.sort(reverse=True)
        want = scores[0][1] if scores[0][0] >= 0.8 and scores[0][0] - scores[1][0] >= 0.05 else ""
        assert got[f"C{i}"] == want


def test_name_fallback(spark):
    policy = Policy(name_tokens=("Ixomora", "Miravoss", "Qornax", "Qorzarn"))
    df = one_page(spark, ["Ixornora Miravoss\nx\nIxornora Miravoss\nQornax Qorzarn", "Ixornora Miravoss\nQornax Qorzarn", "plain"])
    got = {r.case_id: r.name for r in extract.name_fallback(df, policy).collect()}
    assert got == {"C0": "Ixomora Miravoss", "C1": ""}


def test_consensus_and_tie(spark):
    base = [("r", "Ixoul", "registry", 6), ("s", "Ixoul", "sponsor", 7), ("i", "Ixoal", "intake", 10)]

    def resolved(extra):
        rows = [
            ("C", "native", 1, i, 0, "applicant_name", v, s, w) for i, (_, v, s, w) in enumerate(base + extra)
        ]
        return resolve.resolve_evidence(spark.createDataFrame(rows, schemas.EVIDENCE)).first().value

    assert resolved([]) == "Ixoul"
    assert resolved([("n", "Ixoal", "note", 10)]) == "Ixoal"


def test_orientation(spark):
    labels = "Case ID Applicant Species Code Home World Fee Status"
    rows = [("A", 1, 0, "blur"), ("A", 1, 90, labels), ("A", 1, 270, "x"), ("B", 1, 0, labels), ("B", 1, 90, labels + " Finding")]
    df = spark.createDataFrame(rows, "case_id string, page int, angle int, text string")
    assert {r.case_id: r.rotation for r in extract.orient_pages(df).collect()} == {"A": 90, "B": 0}


ROW = {
    **fixed.SENTINELS,
    "visa_class": "XW-2", "fee_status": "paid", "arrival_date": "2026-01-01", "sponsor_id": "SPN-1111",
}
BASE = {"finding": "", "biometrics": False, "approval": False, "review": False, "stale": False, "note": False}
CASCADE = [
    ({"risk_flags": "active_warrant"}, {"biometrics": True}, "DENIED", 3),
    ({**fixed.SENTINELS}, {"approval": True}, "APPROVED", 2),
    ({"fee_status": "unpaid", "visa_class": "TRANSIT-7"}, {"approval": True}, "APPROVED", 2),
    ({"risk_flags": "identity_conflict"}, {"approval": True}, "NEEDS_REVIEW", 4),
    ({"risk_flags": "planetary_embargo"}, {"review": True}, "NEEDS_REVIEW", 1),
    ({}, {"biometrics": True}, "APPROVED", 10),
    ({}, {"biometrics": True, "note": True}, "NEEDS_REVIEW", 11),
    ({"fee_status": "unknown"}, {"biometrics": True}, "NEEDS_REVIEW", 7),
    ({"arrival_date": "2025-08-01"}, {"stale": True}, "DENIED", 5),
    ({"sponsor_id": "SPN-4040"}, {}, "DENIED", 6),
    ({"sponsor_id": "SPN-4040", "fee_status": "waived"}, {}, "NEEDS_REVIEW", 8),
    ({"sponsor_id": "SPN-7331"}, {}, "DENIED", 6),
    ({"fee_status": "waived"}, {}, "NEEDS_REVIEW", 9),
    ({}, {"finding": "DENIED"}, "DENIED", 3),
    ({}, {}, "NEEDS_REVIEW", 11),
]


def test_cascade_truth_table(spark):
    rows = [
        (i, *[{**ROW, **change}[f] for f in fixed.FIELDS], *[{**BASE, **facts}[b] for b in BASE])
        for i, (change, facts, _, _) in enumerate(CASCADE)
    ]
    types = ["i int", *[f"{f} string" for f in fixed.FIELDS], "finding string", *[f"{b} boolean" for b in list(BASE)[1:]]]
    df = spark.createDataFrame(rows, ", ".join(types))
    outcome = decide.decide(
        {f: F.col(f) for f in fixed.FIELDS},
        finding=F.col("finding"), clean_biometrics=F.col("biometrics"), manual_approval=F.col("approval"),
        manual_review=F.col("review"), stale=F.col("stale"), unresolved_note=F.col("note"),
    )
    got = [(r.o.decision, r.o.rule) for r in df.select("i", outcome.alias("o")).orderBy("i").collect()]
    assert got == [(d, r) for _, _, d, r in CASCADE]


def test_ledger_and_fallbacks(spark):
    def candidate(case, field, value, anchor, ocr, crop=1, chain=("crop", "native"), family="label_value_roi", seq=0):
        return (case, field, value, value, 1, (crop, 0, 0, 0), family, list(chain), ocr, anchor, value, seq)

    rows = [
        candidate("L", "fee_status", "unpaid", 0.85, 99.0), candidate("L", "fee_status", "paid", 0.97, 75.0),
        candidate("S", "sponsor_id", "SPN-1234", 1.0, 93.0, 1), candidate("S", "sponsor_id", "SPN-1234", 1.0, 91.0, 2),
        candidate("T", "sponsor_id", "SPN-1234", 1.0, 93.0, 1), candidate("T", "sponsor_id", "SPN-1234", 1.0, 84.9, 2),
        candidate("F", "fee_status", "paid", 1.0, 90.0, family="top_left_fee_band"),
    ]
    df = spark.createDataFrame(rows, schemas.CANDIDATES)
    entry = resolve.resolve_ledger(df).filter("case_id = 'L'").first()
    assert (entry.selected_value, entry.resolution_reason, entry.conflicts) == (
        "paid", "highest_anchor_then_ocr_quality", ["unpaid"],
    )
    assert {r.case_id: r.sponsor_id for r in resolve.corroborated_sponsor(df).collect()} == {"S": "SPN-1234", "T": ""}
    assert resolve.agreed_fee_band(df).collect()[0].fee_status == "paid"


def test_region_proposal(spark):
    rows = [("C", 1, w, 90.0, left, 40, 30, 8, 1, 1, line) for line in range(4) for w, left in (("Fee", 10), ("Status", 42), ("paid", 90))]
    words = spark.createDataFrame(rows, schemas.WORDS)
    found = regions.propose_regions(regions.valid_words(words), 200, 300).collect()
    assert len(found) == 2 and all(r.field_or_section == "fee_status" for r in found)
    box = found[0].bounding_region
    assert found[0].anchor_quality == 1.0 and box.left < 76 and box.right == 200


def test_regions_on_pages_of_different_sizes(spark):
    rows = [(case, 1, w, 90.0, left, 40, 30, 8, 1, 1, 1) for case in "CD" for w, left in (("paid", 90), ("Status", 42), ("Fee", 10))]
    words = spark.createDataFrame(rows, schemas.WORDS)
    wide = F.when(F.col("case_id") == "C", 200).otherwise(60)
    found = regions.propose_regions(words, wide, 50, F.lower("case_id")).collect()
    got = {r.case_id: (r.bounding_region.left, r.bounding_region.right, r.bounding_region.bottom, r.layout_family, r.anchor_text) for r in found}
    assert got == {"C": (74, 200, 50, "c", "Fee Status paid"), "D": (60, 60, 50, "d", "Fee Status paid")}
    assert regions.propose_regions(words.limit(0), 10, 10).count() == 0


def test_spans_against_slices_of_the_line(spark):
    rows = [("C", 1, f"w{i}", 90.0, 10 * i, 40 + i % 2, 9, 8, 1, 1, line) for line in range(3) for i in range(line * 2)]
    got = regions.label_spans(spark.createDataFrame(rows, schemas.WORDS)).collect()
    wanted = {
        (line, start, " ".join(f"w{i}" for i in range(start, start + n)), 10 * (start + n - 1) + 9)
        for line in range(3) for start in range(line * 2) for n in (1, 2, 3) if start + n <= line * 2
    }
    assert {(r.line, r.start, r.span_text, r.right) for r in got} == wanted and len(got) == len(wanted)


def test_scorers(spark):
    text = spark.createDataFrame([("a", "123"), ("b", "987"), ("c", "research"), ("d", "zz")], "case_id string, text string")

    def model(rows, intercepts, **header):
        return tm.Model(spark.createDataFrame(rows, tm.WEIGHTS), intercepts, 10, **header)

    fee = model([("###", 1.0, [2.0, -2.0])], (0.0, 0.0), classes=("paid", "unknown"), minimum_probability=0.5, minimum_margin=0.1)
    risk = model([("res", 1.0, [30.0, 0.0])], (-10.0, -10.0), classes=("active_warrant", "sponsor_mismatch"), thresholds={"active_warrant": 0.65})
    scores = tm.raw_scores(text, ["case_id"], {"fee": fee, "risk": risk})
    rows = {
        r.case_id: r
        for r in scores.select("case_id", tm.multiclass(F.col("fee"), fee).alias("f"), tm.multilabel(F.col("risk"), risk).alias("r")).collect()
    }
    assert rows["a"].f == rows["b"].f and rows["a"].f.value == "paid" and rows["a"].f.accepted
    assert (rows["c"].r, rows["d"].r) == ("active_warrant", "")
    # no known token: the intercepts alone, and the later class wins the tie
    assert (rows["d"].f.value, rows["d"].f.margin) == ("unknown", 0.0)


def test_metric_fixture(spark):
    def table(rows, extra=""):
        names = ["case_id", *fixed.FIELDS, "adjudication"]
        return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names) + extra)

    def record(case, decision, **change):
        return (case, *[{**fixed.SENTINELS, **change}[f] for f in fixed.FIELDS], decision)

    predictions = table([(*record("a", "APPROVED"), 0.8), (*record("b", "NEEDS_REVIEW", fee_status="paid"), 0.6)], ", confidence double")
    truth = table([record("a", "DENIED"), record("b", "NEEDS_REVIEW", fee_status="unpaid")])
    pairs = evaluate.compared(predictions, truth)
    summary = evaluate.decision_summary(pairs).first()
    assert (summary.catastrophic_false_approvals, summary.brier) == (1, 0.4)
    fee = evaluate.per_field_accuracy(pairs).filter("field = 'fee_status'").first()
    assert (fee.correct, fee.total) == (1, 2)
    change = {r.metric: r.value for r in evaluate.change_vs_baseline(predictions, table([record("a", "NEEDS_REVIEW")])).collect()}
    assert change["approval_additions"] == 1 and change["shared_rows"] == 1


def test_pipeline_order(spark):
    rows = [
        # clean approval over four pages; damaged world and name are repaired
        ("A", 1, 0, "native", "Interstellar Intake - Work Authorization\nApplicant Name: Ixornora Miravoss\nSpecies Code\nORION_GRAYS\nHome World: Barmard-c\nVisa Class: MED-3\nSponsor ID: SPN-1234\nArrival Date: 2026/03/11\nDeclared Purpose: research"),
        ("A", 2, 0, "native", "Fee Receipt\nFee Status: paid\nAmount $809.00"),
        ("A", 3, 0, "native", "Biometric Screening B-13\nObserved Flags: none"),
        # a denied note wins; the packet has no other page
        ("B", 1, 0, "native", "Adjudicator manual note\nFinding: DENIED\nManual correction: fee status is waived"),
        # two distinct manual findings mean review
        ("C", 1, 0, "native", "Adjudicator manual note\nFinding: DENIED"),
        ("C", 2, 0, "native", "Adjudicator manual note\nFinding: APPROVED"),
        # attestation binds sponsor, purpose and visa, and replaces a missing name
        ("D", 1, 0, "native", "Sponsor SPN-4321 attests that Veenax Ixoul is expected on Earth for transit. The sponsor accepts responsibility for class XW-1 compliance."),
        # sponsor read twice with look-alike letters is recovered after the decision
        ("E", 1, 0, "native", "note SPN-OI2B\nand SPN-0128 again"),
        # retry fills what native lacks, and adds an adverse flag
        ("F", 1, 0, "native", "Visa Class: MED-3"),
        ("F", 1, 1, "retry", "Visa Class: XW-1\nFee Status: waived\nObserved Flags: biohazard_red"),
    ]
    cases = spark.createDataFrame([(c,) for c in "ABCDEFG"], "case_id string")
    got = {r.case_id: r for r in plan.adjudicate(readings(spark, rows), cases=cases).collect()}
    a = got["A"]
    assert (a.adjudication, a.confidence, a.applicant_name, a.home_world) == ("APPROVED", 0.98, "Ixomora Miravoss", "Barnard-c")
    assert (got["B"].adjudication, got["B"].fee_status) == ("DENIED", "waived")
    assert (got["C"].adjudication, got["C"].confidence) == ("NEEDS_REVIEW", 0.99)
    d = got["D"]
    assert (d.applicant_name, d.sponsor_id, d.declared_purpose, d.visa_class) == ("Veenax Ixoul", "SPN-4321", "transit", "XW-1")
    assert got["E"].sponsor_id == "SPN-0128"
    f = got["F"]
    assert (f.visa_class, f.fee_status, f.risk_flags, f.adjudication) == ("MED-3", "waived", "biohazard_red", "DENIED")
    # a packet without any fact still has a record
    assert got["G"].adjudication == "NEEDS_REVIEW" and got["G"].applicant_name == "unknown"


def test_labels_that_only_start_like_a_name_label(spark):
    texts = ["applicant names foo bar", "Applicant name foo bar", "applicant named foo", "applicnt ann lee"]
    rows = extract.approximate_applicants(one_page(spark, texts), F.col("text")).select("case_id", "approximate").collect()
    got = {r.case_id: r.approximate for r in rows}
    assert got == {"C0": ["Names Foo"], "C1": ["Foo Bar"], "C2": ["Named Foo"], "C3": ["Ann Lee"]}


def test_pairs_of_words_of_any_length(spark, values):
    long = "x" + "-'" * 60 + "y"
    first = values(lambda c: extract.name_pairs(c)[0], [f"{long} Ab, cd\nEf", "one", ""])
    second = values(lambda c: extract.name_pairs(c)[1], [f"{long} Ab, cd\nEf", "one", ""])
    assert first == [[long, "Ab"], [], []] and second == [["Ab", "cd"], [], []]


def test_windows_follow_the_length_of_the_missed_value(spark):
    from difflib import SequenceMatcher

    from evidentia.functions import similarity

    targets = ["a bb ccc dddd eeeee ffffff", "one two three four five six seven eight", "solo"]
    text = "zz a bb ccc dddx eeeee ffffff one two three four fiv six seven eight sola"
    df = spark.createDataFrame([(targets, text)], "t array<string>, x string")
    got = df.select(similarity.best_windows()("t", "x").alias("s")).first().s
    near = ["a bb ccc dddx eeeee ffffff", "one two three four fiv six seven eight", "sola"]
    assert all(g >= SequenceMatcher(None, t, n).ratio() - 1e-9 for g, t, n in zip(got, targets, near))
    assert min(got[:2]) > 0.95


def test_damaged_years_are_policy(spark, values):
    other = Policy(misread_year=("2031", "2037"))
    from evidentia.functions import fields

    assert values(lambda c: fields.damaged_dates(c, other), ["Arrival Date 2031-08-09", "Arrival Date 2028-08-09"]) == [["2037-06-09"], []]


def test_rows_without_a_score_keep_their_place(spark):
    from evidentia.operators import rank

    df = spark.createDataFrame([(1, 0.5), (2, None), (3, 0.9)], "id int, s double")
    got = {r.id: r.p for r in rank.average_rank(df, "s", "p").collect()}
    assert got == {1: 0.5, 2: None, 3: 1.0}


def test_label_matches_score_a_run_once_per_task(monkeypatch):
    labels, calls = [("fee status", 2), ("home world", 2)], []
    plain = similarity.make_ratio()
    monkeypatch.setattr(similarity, "make_ratio", lambda: lambda *a: calls.append(a) or plain(*a))
    match = similarity.label_matches(labels, 0.8).func
    runs = pd.Series(["fee statu5", "", "the fee status", "zzzzzzzzzz", "fee statu5"])
    batches = [(runs, pd.Series([2, 1, 3, 1, 4]))] * 3
    got = [list(out) for out in match(iter(batches))]
    assert got[0] == got[1] == got[2]
    assert got[0] == [[{"place": 0, "quality": 0.9}], None, [{"place": 0, "quality": 1.0}], None, None]
    assert len(calls) == len(set(calls))
