"""Evaluation: accuracy, confusion, calibration, coverage, change, failures.

Counters are conditional sums of one pass over a key join; the long form is
made from the single aggregated row, never from the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from evidentia import policy as fixed
from evidentia.functions import fields as fn, similarity, text as tx
from evidentia.policy import DEFAULT, Policy

MEASURED = (*fixed.FIELDS, "adjudication")
SAME = "same_"


def compared(predictions: DataFrame, truth: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Inner join on the key with one equality flag per field and the decision."""
    expected = truth.select(
        "case_id", *[F.col(f).alias(f"true_{f}") for f in MEASURED], *keep
    )
    return predictions.join(expected, "case_id").withColumns(
        {f"{SAME}{f}": F.col(f).eqNullSafe(F.col(f"true_{f}")) for f in MEASURED}
    )


def _correct(field: str) -> Column:
    return F.count_if(F.col(f"{SAME}{field}")).alias(field)


def per_field_accuracy(pairs: DataFrame) -> DataFrame:
    totals = pairs.agg(F.count(F.lit(1)).alias("total"), *[_correct(f) for f in fixed.FIELDS])
    long = totals.unpivot(["total"], list(fixed.FIELDS), "field", "correct")
    return long.select("field", "correct", "total", fn.ratio(F.col("correct"), F.col("total")).alias("accuracy"))


def confusion(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(
        F.col("true_adjudication").alias("actual"), F.col("adjudication").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("cases"))


def confusion_pivot(pairs: DataFrame, classes=("APPROVED", "DENIED", "NEEDS_REVIEW")) -> DataFrame:
    return pairs.groupBy(F.col("true_adjudication").alias("actual")).agg(
        *[F.count_if(F.col("adjudication") == c).alias(c.lower()) for c in classes]
    )


def brier_term() -> Column:
    error = F.col("confidence") - F.col(f"{SAME}adjudication").cast("double")
    return error * error


def catastrophic() -> Column:
    return (F.col("adjudication") == "APPROVED") & (F.col("true_adjudication") == "DENIED")


def decision_summary(pairs: DataFrame) -> DataFrame:
    total, right = F.count(F.lit(1)), F.count_if(F.col(f"{SAME}adjudication"))
    return pairs.agg(
        right.alias("correct"),
        total.alias("total"),
        fn.ratio(right, total).alias("accuracy"),
        F.round(F.avg(brier_term()), 6).alias("brier"),
        F.count_if(catastrophic()).alias("catastrophic_false_approvals"),
    )


def coverage(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    left = predictions.select("case_id", F.lit(1).alias("p"))
    right = truth.select("case_id", F.lit(1).alias("t"))
    both = left.join(right, "case_id", "full")
    return both.agg(
        F.count_if(F.col("p").isNotNull() & F.col("t").isNotNull()).alias("comparable_rows"),
        F.count_if(F.col("p").isNull()).alias("missing_prediction_ids"),
        F.count_if(F.col("t").isNull()).alias("extra_prediction_ids"),
    )


def change_vs_baseline(predictions: DataFrame, baseline: DataFrame) -> DataFrame:
    old = baseline.select("case_id", *[F.col(f).alias(f"old_{f}") for f in MEASURED])
    pairs = predictions.join(old, "case_id")
    now, before = F.col("adjudication") == "APPROVED", F.col("old_adjudication") == "APPROVED"
    counters = {
        "shared_rows": F.count(F.lit(1)),
        "adjudication_changes": F.count_if(F.col("adjudication") != F.col("old_adjudication")),
        "approval_additions": F.count_if(now & ~before),
        "approval_removals": F.count_if(~now & before),
        **{f"changed_{f}": F.count_if(F.col(f) != F.col(f"old_{f}")) for f in fixed.FIELDS},
    }
    row = pairs.agg(*[c.alias(n) for n, c in counters.items()])
    return row.unpivot([], list(counters), "metric", "value")


def grouped_metrics(pairs: DataFrame, group: str) -> DataFrame:
    """Metrics per group and overall; the overall row sums the group rows."""
    per_group = pairs.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"),
        *[_correct(f) for f in MEASURED],
    )
    sums = ["rows", *MEASURED]
    rolled = per_group.groupingSets([[group], []], group).agg(*[F.sum(c).alias(c) for c in sums])
    return rolled.select(
        F.coalesce(group, F.lit("(all)")).alias("grp"),
        "rows",
        *[fn.ratio(F.col(f), F.col("rows")).alias(f"accuracy_{f}") for f in MEASURED],
    )


def strict_join(rows: DataFrame, known: DataFrame, key: str = "case_id") -> DataFrame:
    """``rows`` with the columns of ``known``; the action fails when ``known`` lacks a key of ``rows``.

    ``known`` holds a key once. Checked where rows are joined, so no pass is added.
    """
    joined = rows.join(known.withColumn("__held", F.lit(True)), key, "left")
    absent = F.concat(F.lit(f"no row for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return joined.filter(F.assert_true(F.col("__held").isNotNull(), absent).isNull()).drop("__held")


def missing_groups(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Comparable cases the group map does not know; must be empty to report."""
    return pairs.select("case_id").join(groups.select("case_id"), "case_id", "left_anti")


def composite_score(pairs: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Extraction of 50, classification of 80, calibration of 20.

    Extraction weighs exact fields; classification gives 8 for the right
    decision, 2 for a decided case left in review, 1 for a true review decided
    either way; calibration is linear in the Brier score.
    """
    n = F.count(F.lit(1))
    weight = sum(policy.weights.values())
    exact = sum(
        (F.count_if(F.col(f"{SAME}{f}")) * F.lit(policy.weights[f]) for f in fixed.FIELDS), start=F.lit(0.0)
    )
    actual, predicted = F.col("true_adjudication"), F.col("adjudication")
    utility = F.sum(
        F.when(F.col(f"{SAME}adjudication"), 8)
        .when(predicted == "NEEDS_REVIEW", 2)
        .when(actual == "NEEDS_REVIEW", 1)
        .otherwise(0)
    )
    parts = pairs.agg(
        (exact * 50.0 / (n * weight)).alias("extraction"),
        (utility * 10.0 / n).alias("classification"),
        (20.0 * (1.0 - 2.0 * F.avg(brier_term()))).alias("calibration"),
    )
    rounded = parts.select(*[F.round(c, 6).alias(c) for c in parts.columns])
    return rounded.withColumn(
        "total", F.round(F.col("extraction") + F.col("classification") + F.col("calibration"), 6)
    )


def calibration_by_reason(pairs: DataFrame, reason: str) -> DataFrame:
    """Observed correctness per decision reason, to recompute the fixed confidences."""
    return pairs.groupBy(reason).agg(
        F.count(F.lit(1)).alias("cases"),
        F.round(F.avg(F.col(f"{SAME}adjudication").cast("double")), 6).alias("observed"),
        F.round(F.avg("confidence"), 6).alias("stated"),
    )


# -- traces ----------------------------------------------------------------


def trace_counters(traces: DataFrame) -> DataFrame:
    """One row of counters over nested traces.

    A retry is a recovery when it is valid and no native reading of the same
    (field, page, crop) on that page was; traces of a page are small.
    """
    pages = traces.select("case_id", F.posexplode_outer("pages").alias("n", "page")).filter(
        F.col("page").isNotNull()
    )
    reads = pages.select("case_id", "n", F.explode_outer("page.roi_candidates").alias("c")).filter(
        F.col("c").isNotNull()
    )
    retry = F.array_contains(F.coalesce("c.transform_chain", F.array()), "rescale_2x")
    valid = F.coalesce(F.col("c.normalized_value"), F.lit("")) != ""
    per_crop = reads.groupBy("case_id", "n", "c.field", "c.page", "c.crop").agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if(valid).alias("valid_candidates"),
        F.count_if(retry).alias("retry_reads"),
        F.when(~F.coalesce(F.bool_or(valid & ~retry), F.lit(False)), F.count_if(valid & retry))
        .otherwise(0)
        .alias("retry_recoveries"),
    )
    reading_sums = per_crop.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("candidates", "valid_candidates", "retry_reads", "retry_recoveries")
        ]
    )
    selected = F.filter(
        F.coalesce("evidence_ledger", F.array().cast(traces.schema["evidence_ledger"].dataType)),
        lambda e: F.coalesce(e["selected_value"], F.lit("")) != "",
    )
    conflicts = F.aggregate(
        F.coalesce("evidence_ledger", F.array().cast(traces.schema["evidence_ledger"].dataType)),
        F.lit(0),
        lambda n, e: n + F.size(e["conflicts"]),
    )
    proposals = F.aggregate("pages", F.lit(0), lambda n, p: n + F.size(p["region_proposals"]))
    case_sums = traces.agg(
        F.count(F.lit(1)).alias("cases"),
        F.sum(F.size("pages")).alias("pages"),
        F.sum(proposals).alias("region_proposals"),
        F.sum(F.size(selected)).alias("selected_ledger_fields"),
        F.sum(conflicts).alias("conflicting_values"),
    )
    # two single-row results side by side
    both = case_sums.withColumn("one", F.lit(1)).join(reading_sums.withColumn("one", F.lit(1)), "one")
    return both.select(
        *["cases", "pages", "region_proposals"],
        F.col("candidates").alias("roi_candidates"),
        *["valid_candidates", "retry_reads", "retry_recoveries", "selected_ledger_fields", "conflicting_values"],
        fn.ratio(F.col("region_proposals"), F.col("pages")).alias("proposals_per_page"),
        fn.ratio(F.col("candidates"), F.col("pages")).alias("candidates_per_page"),
    )


# -- failures --------------------------------------------------------------


def field_misses(pairs: DataFrame) -> DataFrame:
    """One row per (case, field) whose folded value differs from the truth."""
    rows = pairs.select(
        "case_id",
        F.col("adjudication").alias("predicted_adjudication"),
        F.col("true_adjudication").alias("truth_adjudication"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(f).alias("field"),
                        F.col(f"true_{f}").alias("expected"),
                        F.col(f).alias("observed"),
                        F.lit(fixed.SENTINELS[f]).alias("sentinel"),
                    )
                    for f in fixed.FIELDS
                ]
            )
        ).alias("m"),
    ).select("case_id", "predicted_adjudication", "truth_adjudication", "m.*")
    keyed = rows.withColumns(
        {"expected_key": tx.anchor_text(F.col("expected")), "observed_key": tx.anchor_text(F.col("observed"))}
    )
    return keyed.filter(F.col("expected_key") != F.col("observed_key")).withColumn(
        "output_is_default", F.col("observed_key") == tx.anchor_text(F.col("sentinel"))
    )


def classify_misses(
    misses: DataFrame, texts: DataFrame, policy: Policy = DEFAULT, similarity_scores: bool = True
) -> DataFrame:
    """Failure class of every miss against the visible text of its case.

    ``texts`` holds readings of a case; the expected value is looked up in
    each and folded with max, so texts are never concatenated per case.
    """
    keys = F.collect_list(F.struct("field", F.nullif("expected_key", F.lit("")).alias("key")))  # one for each field at most
    wanted = misses.groupBy("case_id").agg(keys.alias("wanted"))
    visible = texts.select("case_id", tx.anchor_text(F.col("text")).alias("visible"))
    rows = wanted.join(visible, "case_id")
    exact = F.transform("wanted", lambda w: F.coalesce(F.contains(F.col("visible"), w["key"]), F.lit(False)))
    rows = rows.withColumn("exact", exact)
    none = F.transform("wanted", lambda w: F.lit(0.0))
    if similarity_scores:
        left = F.zip_with("wanted", "exact", lambda w, e: F.when(~e, w["key"]))
        rows = rows.withColumn("scores", F.coalesce(similarity.best_windows()(left, F.col("visible")), none))
    else:
        rows = rows.withColumn("scores", none)
    facts = rows.select("case_id", F.explode(F.arrays_zip("wanted", "exact", "scores")).alias("f"))
    facts = facts.select("case_id", "f.wanted.field", "f.exact", F.coalesce(F.round("f.scores", 4), F.lit(0.0)).alias("score"))
    exact = F.col("exact")
    score = F.when(exact, 1.0).otherwise(F.col("score"))
    found = facts.groupBy("case_id", "field").agg(
        F.bool_or(exact).alias("exact_visible"), F.max(score).alias("best_similarity")
    )
    joined = misses.join(found, ["case_id", "field"], "left")
    return joined.withColumns(
        {
            "exact_visible": F.coalesce("exact_visible", F.lit(False)),
            "best_similarity": F.coalesce("best_similarity", F.lit(0.0)),
        }
    ).withColumn(
        "failure_class",
        F.when(F.col("exact_visible"), "binding_or_resolution")
        .when(F.col("best_similarity") >= policy.near_read_score, "near_ocr_read")
        .otherwise("not_recovered_by_whole_page_ocr"),
    )


def miss_summary(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """Exact, sentinel and other misses per field over all truth rows."""
    got = predictions.select("case_id", *[F.col(f).alias(f"got_{f}") for f in fixed.FIELDS])
    rows = truth.join(got, "case_id", "left")

    def folded(c: Column) -> Column:
        return tx.casefold(tx.normalize_space(c))

    row = rows.agg(
        *[
            F.struct(
                F.count_if(folded(F.col(f"got_{f}")) == folded(F.col(f))).alias("exact"),
                F.count_if(
                    (folded(F.col(f"got_{f}")) != folded(F.col(f)))
                    & (folded(F.col(f"got_{f}")) == fixed.SENTINELS[f].lower())
                ).alias("sentinel_misses"),
                F.count(F.lit(1)).alias("rows"),
            ).alias(f)
            for f in fixed.FIELDS
        ]
    )
    long = row.unpivot([], list(fixed.FIELDS), "field", "m")
    return long.select(
        "field",
        F.col("m.exact").alias("exact"),
        (F.col("m.rows") - F.col("m.exact")).alias("misses"),
        F.col("m.sentinel_misses").alias("sentinel_misses"),
        (F.col("m.rows") - F.col("m.exact") - F.col("m.sentinel_misses")).alias("nondefault_wrong_misses"),
    )
