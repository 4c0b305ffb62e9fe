"""Reports over predictions, truth, baseline and traces."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia import policy as fixed, schemas
from evidentia.operators import evaluate as op, rank
from evidentia.plans import bindings as src, sqltext as q
from evidentia.plans.catalog import Catalog
from evidentia.plans.catalog.resolve import CANDIDATES, candidates
from evidentia.policy import DEFAULT
from evidentia.session import shared_path
from evidentia.sources import readers, sinks

catalog = Catalog()
BOTH = f"with {src.cte('predictions', src.PREDICTIONS)}, {src.cte('truth', src.TRUTH)}"
PAIRS = (
    BOTH
    + ", pairs as (select p.*, t.grp, "
    + ", ".join(f"t.{f} as true_{f}, (p.{f} = t.{f}) as same_{f}" for f in op.MEASURED)
    + " from predictions p join truth t using (case_id))"
)


def pairs(spark, folder):
    return op.compared(
        src.bind(spark, folder, src.PREDICTIONS), src.bind(spark, folder, src.TRUTH), ("grp",)
    )


@catalog.add(
    "per_field_accuracy",
    PAIRS + " " + " union all ".join(
        f"select '{f}' as field, count(*) filter (where same_{f}) as correct, count(*) as total, "
        f"round(count(*) filter (where same_{f}) / count(*), 6) as accuracy from pairs"
        for f in fixed.FIELDS
    ),
)
def per_field_accuracy(spark, folder):
    return op.per_field_accuracy(pairs(spark, folder))


@catalog.add(
    "confusion",
    PAIRS + " select true_adjudication as actual, adjudication as predicted, count(*) as cases from pairs group by all",
)
def confusion(spark, folder):
    return op.confusion(pairs(spark, folder))


@catalog.add(
    "confusion_pivot",
    PAIRS + " select true_adjudication as actual, "
    + ", ".join(f"count(*) filter (where adjudication = '{c}') as {c.lower()}" for c in ("APPROVED", "DENIED", "NEEDS_REVIEW"))
    + " from pairs group by all",
)
def confusion_pivot(spark, folder):
    return op.confusion_pivot(pairs(spark, folder))


@catalog.add(
    "decision_summary",
    PAIRS + " select count(*) filter (where same_adjudication) as correct, count(*) as total, "
    "round(count(*) filter (where same_adjudication) / count(*), 6) as accuracy, "
    "round(avg(pow(confidence - same_adjudication::int, 2)), 6) as brier, "
    "count(*) filter (where adjudication = 'APPROVED' and true_adjudication = 'DENIED') as catastrophic_false_approvals from pairs",
)
def decision_summary(spark, folder):
    return op.decision_summary(pairs(spark, folder))


@catalog.add(
    "coverage_full_outer",
    BOTH + " select count(*) filter (where p.case_id is not null and t.case_id is not null) as comparable_rows, "
    "count(*) filter (where p.case_id is null) as missing_prediction_ids, count(*) filter (where t.case_id is null) as extra_prediction_ids "
    "from predictions p full join truth t on p.case_id = t.case_id",
)
def coverage_full_outer(spark, folder):
    return op.coverage(src.bind(spark, folder, src.PREDICTIONS), src.bind(spark, folder, src.TRUTH))


@catalog.add("missing_keys_anti", BOTH + " select case_id from truth where case_id not in (select case_id from predictions)")
def missing_keys_anti(spark, folder):
    predictions = src.bind(spark, folder, src.PREDICTIONS).select("case_id")
    return src.bind(spark, folder, src.TRUTH).select("case_id").join(predictions, "case_id", "left_anti")


@catalog.add("extra_keys_except", BOTH + " select case_id from predictions except select case_id from truth")
def extra_keys_except(spark, folder):
    predictions = src.bind(spark, folder, src.PREDICTIONS).select("case_id")
    return predictions.exceptAll(src.bind(spark, folder, src.TRUTH).select("case_id"))


@catalog.add("shared_keys_intersect", BOTH + " select case_id from predictions intersect select case_id from truth")
def shared_keys_intersect(spark, folder):
    predictions = src.bind(spark, folder, src.PREDICTIONS).select("case_id")
    return predictions.intersect(src.bind(spark, folder, src.TRUTH).select("case_id"))


_CHANGES = {
    "shared_rows": "true",
    "adjudication_changes": "p.adjudication <> b.adjudication",
    "approval_additions": "p.adjudication = 'APPROVED' and b.adjudication <> 'APPROVED'",
    "approval_removals": "p.adjudication <> 'APPROVED' and b.adjudication = 'APPROVED'",
    **{f"changed_{f}": f"p.{f} <> b.{f}" for f in fixed.FIELDS},
}


@catalog.add(
    "change_vs_baseline",
    f"with {src.cte('predictions', src.PREDICTIONS)}, {src.cte('baseline', src.BASELINE)} "
    + " union all ".join(
        f"select '{n}' as metric, count(*) filter (where {c}) as value from predictions p join baseline b using (case_id)"
        for n, c in _CHANGES.items()
    ),
)
def change_vs_baseline(spark, folder):
    return op.change_vs_baseline(
        src.bind(spark, folder, src.PREDICTIONS), src.bind(spark, folder, src.BASELINE)
    )


@catalog.add(
    "grouped_metrics",
    PAIRS + " select coalesce(grp, '(all)') as grp, count(*) as rows, "
    + ", ".join(f"round(count(*) filter (where same_{f}) / count(*), 6) as accuracy_{f}" for f in op.MEASURED)
    + " from pairs group by grouping sets ((), (grp))",
)
def grouped_metrics(spark, folder):
    return op.grouped_metrics(pairs(spark, folder), "grp")


@catalog.add(
    "missing_groups",
    PAIRS + " select case_id from pairs where case_id not in (select case_id from truth where k % 50 <> 3)",
)
def missing_groups(spark, folder):
    groups = src.bind(spark, folder, src.TRUTH).filter(F.col("k") % 50 != 3)
    return op.missing_groups(pairs(spark, folder), groups)


_WEIGHTED = " + ".join(f"count(*) filter (where same_{f}) * {w}" for f, w in DEFAULT.weights.items())


@catalog.add(
    "composite_score",
    PAIRS + f", s as (select round(cast({_WEIGHTED} as double) * 50.0 / (count(*) * 9.0), 6) as extraction, "
    "round(sum(case when same_adjudication then 8 when adjudication = 'NEEDS_REVIEW' then 2 when true_adjudication = 'NEEDS_REVIEW' then 1 else 0 end) * 10.0 / count(*), 6)::double as classification, "
    "round(20.0 * (1.0 - 2.0 * avg(pow(confidence - same_adjudication::int, 2))), 6) as calibration from pairs) "
    "select *, round(extraction + classification + calibration, 6) as total from s",
)
def composite_score(spark, folder):
    return op.composite_score(pairs(spark, folder))


@catalog.add(
    "calibration_by_reason",
    PAIRS + " select k % 7 as reason, count(*) as cases, round(avg(same_adjudication::int), 6) as observed, round(avg(confidence), 6) as stated from pairs group by 1",
)
def calibration_by_reason(spark, folder):
    rows = pairs(spark, folder).withColumn("reason", F.col("k") % 7)
    return op.calibration_by_reason(rows, "reason")


def traces(spark, folder):
    """Nested traces from the flat crop readings, through JSON text and back.

    A trace is one case, so its candidates are few by construction.
    """
    flat = candidates(spark, folder)
    candidate = F.struct(
        "field",
        "page",
        F.array("page", F.col("crop.box").cast("int")).alias("crop"),
        "transform_chain",
        "normalized_value",
    )
    per_page = flat.groupBy("case_id", "page").agg(F.collect_list(candidate).alias("roi_candidates"))
    pages = per_page.groupBy("case_id").agg(
        F.collect_list(
            F.struct(
                F.array(F.struct(F.lit("sponsor_id").alias("field_or_section"), "page")).alias("region_proposals"),
                "roi_candidates",
            )
        ).alias("pages")
    )
    from evidentia.operators import resolve

    ledger = (
        resolve.resolve_ledger(flat)
        .groupBy("case_id")
        .agg(
            F.collect_list(F.struct("field", "selected_value", "resolution_reason", "conflicts")).alias(
                "evidence_ledger"
            )
        )
    )
    text = pages.join(ledger, "case_id").select(F.to_json(F.struct("*")).alias("trace"))
    return text.select(F.from_json("trace", schemas.TRACE).alias("t")).select("t.*")


TRACE_COUNTERS = (
    CANDIDATES
    + ", crop as (select case_id, field, page, crop_no, count(*) as n, count(*) filter (where value <> '') as v, "
    "count(*) filter (where chain = 'crop+rescale_2x') as r, case when bool_or(value <> '' and chain = 'crop+native') then 0 "
    "else count(*) filter (where value <> '' and chain = 'crop+rescale_2x') end as rec from candidates group by all), "
    "best as (select case_id, field, value from candidates where value <> '' qualify row_number() over (partition by case_id, field order by anchor_quality desc, ocr_quality desc, seq) = 1), "
    "pg as (select count(distinct (case_id, page)) as pages, count(distinct case_id) as cases from candidates) "
    "select any_value(pg.cases) as cases, any_value(pg.pages) as pages, any_value(pg.pages) as region_proposals, sum(n)::bigint as roi_candidates, sum(v)::bigint as valid_candidates, "
    "sum(r)::bigint as retry_reads, sum(rec)::bigint as retry_recoveries, (select count(*) from best) as selected_ledger_fields, "
    "(select count(*) from (select distinct c.case_id, c.field, c.value from candidates c join best b using (case_id, field) where c.value <> '' and c.value <> b.value)) as conflicting_values, "
    "1.0::double as proposals_per_page, round(sum(n) / any_value(pg.pages), 6) as candidates_per_page from crop, pg"
)


@catalog.add("trace_counters", TRACE_COUNTERS)
def trace_counters(spark, folder):
    return op.trace_counters(traces(spark, folder))


@catalog.add("trace_files", TRACE_COUNTERS)
def trace_files(spark, folder):
    """The counters from files, one per case, written to the shared folder and read again."""
    path = shared_path(spark, "traces")
    sinks.write_traces(traces(spark, folder), path)
    return op.trace_counters(readers.read_traces(spark, path))


@catalog.add(
    "strict_case_texts",
    f"with {src.cte('truth', src.TRUTH)}, {src.cte('readings', src.READINGS)} select t.case_id, t.adjudication, count(*) as readings, "
    "sum(length(r.text))::bigint as characters from truth t left join readings r using (case_id) group by all",
)
def strict_case_texts(spark, folder):
    """Labelled cases with what a fit reads of them; a case without a reading would fail the query."""
    texts = src.bind(spark, folder, src.READINGS).groupBy("case_id").agg(
        F.count(F.lit(1)).alias("readings"), F.sum(F.length("text")).alias("characters")
    )
    return op.strict_join(src.bind(spark, folder, src.TRUTH).select("case_id", "adjudication"), texts)


@catalog.add(
    "failure_classes",
    PAIRS + f", {src.cte('readings', src.READINGS)}, m as ("
    + " union all ".join(
        f"select case_id, '{f}' as field, {q.anchor('true_' + f)} as e, {q.anchor(f)} as o, '{q_s}' as s from pairs"
        for f, q_s in ((f, __import__("re").sub("[^a-z0-9]+", " ", s.lower()).strip()) for f, s in fixed.SENTINELS.items())
    )
    + f"), miss as (select * from m where e <> o), v as materialized (select case_id, {q.anchor('text')} as t from readings), "
    "x as (select m.case_id, m.field, max((m.e <> '' and contains(v.t, m.e))::int) = 1 as exact from miss m join v using (case_id) group by all) "
    "select m.field, case when coalesce(x.exact, false) then 'binding_or_resolution' else 'not_recovered_by_whole_page_ocr' end as failure_class, m.o = m.s as output_is_default, count(*) as misses "
    "from miss m left join x using (case_id, field) group by all",
)
def failure_classes(spark, folder):
    misses = op.field_misses(pairs(spark, folder))
    ledger = op.classify_misses(misses, src.readings(spark, folder), similarity_scores=False)
    return ledger.groupBy("field", "failure_class", "output_is_default").agg(
        F.count(F.lit(1)).alias("misses")
    )


@catalog.add(
    "miss_summary",
    BOTH + " " + " union all ".join(
        f"select '{f}' as field, count(*) filter (where lower(p.{f}) = lower(t.{f})) as exact, count(*) - count(*) filter (where lower(p.{f}) = lower(t.{f})) as misses, "
        f"count(*) filter (where lower(p.{f}) <> lower(t.{f}) and lower(p.{f}) = '{s.lower()}') as sentinel_misses, "
        f"count(*) - count(*) filter (where lower(p.{f}) = lower(t.{f})) - count(*) filter (where lower(p.{f}) <> lower(t.{f}) and lower(p.{f}) = '{s.lower()}') as nondefault_wrong_misses "
        "from truth t left join predictions p using (case_id)"
        for f, s in fixed.SENTINELS.items()
    ),
)
def miss_summary(spark, folder):
    return op.miss_summary(src.bind(spark, folder, src.TRUTH), src.bind(spark, folder, src.PREDICTIONS))


@catalog.add(
    "examples_first_n",
    PAIRS + ", m as (" + " union all ".join(
        f"select '{f}' as field, case_id, true_{f} as expected, {f} as observed from pairs where {q.anchor('true_' + f)} <> {q.anchor(f)}"
        for f in fixed.FIELDS
    ) + ") select * from m qualify row_number() over (partition by field order by case_id) <= 12",
)
def examples_first_n(spark, folder):
    misses = op.field_misses(pairs(spark, folder))
    return rank.first_n(misses, ["field"], ["case_id"], 12).select("field", "case_id", "expected", "observed")


@catalog.add(
    "decision_pairs_outer",
    BOTH + " select t.adjudication || '->' || coalesce(p.adjudication, 'MISSING') as pair, count(*) as cases "
    "from truth t left join predictions p using (case_id) group by 1",
)
def decision_pairs_outer(spark, folder):
    got = src.bind(spark, folder, src.PREDICTIONS).select("case_id", F.col("adjudication").alias("got"))
    rows = src.bind(spark, folder, src.TRUTH).join(got, "case_id", "left")
    pair = F.concat_ws("->", "adjudication", F.coalesce("got", F.lit("MISSING")))
    return rows.groupBy(pair.alias("pair")).agg(F.count(F.lit(1)).alias("cases"))
