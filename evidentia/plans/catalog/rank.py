"""Ranking, sweeps, grids, splits and calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia import policy as fixed
from evidentia.operators import rank as op, sweep
from evidentia.plans import bindings as src
from evidentia.plans.catalog import Catalog
from evidentia.plans.catalog.decide import SCORES
from evidentia.plans.catalog.evaluate import PAIRS, pairs
from evidentia.policy import DEFAULT

catalog = Catalog()
_HALF = "(('0x' || substr(sha256(case_id), 1, 8))::ubigint % 2)::bigint"


@catalog.add(
    "top2_margin",
    PAIRS + ", s as (select case_id, unnest([['APPROVED', (k * 7 % 101)::varchar], ['DENIED', (k * 11 % 101)::varchar], ['NEEDS_REVIEW', (k * 13 % 101)::varchar]]) as v from pairs), "
    "r as (select case_id, v[1] as value, v[2]::double / 100.0 as score, row_number() over (partition by case_id order by v[2]::double desc, v[1] desc) as r from s) "
    "select a.case_id, a.value as best, round(a.score - b.score, 6) as margin from r a join r b on a.case_id = b.case_id and a.r = 1 and b.r = 2",
)
def top2_margin(spark, folder):
    rows = pairs(spark, folder)
    scores = F.array(
        *[
            F.struct(((F.col("k") * m) % 101 / 100.0).alias("score"), F.lit(v).alias("value"))
            for m, v in ((7, "APPROVED"), (11, "DENIED"), (13, "NEEDS_REVIEW"))
        ]
    )
    best, margin = op.top_two(scores)
    return rows.select("case_id", best["value"].alias("best"), F.round(margin, 6).alias("margin"))


@catalog.add(
    "first_n_per_key",
    "select * from (select event_type, event_id, user_id from events qualify row_number() over (partition by event_type order by value desc, event_id) <= 25)",
)
def first_n_per_key(spark, folder):
    events = src.table(spark, folder, "events")
    top = op.first_n(events, ["event_type"], [F.desc("value"), F.col("event_id")], 25)
    return top.select("event_type", "event_id", "user_id")


@catalog.add(
    "stratified_cohort",
    PAIRS + f" select true_adjudication as actual, {_HALF} as half, case_id from pairs where true_adjudication in ('APPROVED', 'DENIED') and adjudication = 'NEEDS_REVIEW' "
    f"qualify row_number() over (partition by true_adjudication, {_HALF} order by case_id) <= 30",
)
def stratified_cohort(spark, folder):
    rows = pairs(spark, folder).select(
        F.col("true_adjudication").alias("actual"),
        op.hash_half(F.col("case_id")).alias("half"),
        "case_id",
        "adjudication",
    )
    wanted = rows.filter(F.col("actual").isin("APPROVED", "DENIED") & (F.col("adjudication") == "NEEDS_REVIEW"))
    return op.first_n(wanted, ["actual", "half"], ["case_id"], 30).drop("adjudication")


@catalog.add(
    "avg_rank_percentile",
    "with r as (select event_id, (rank() over (order by value) + (count(*) over (partition by value) - 1) / 2.0) / count(*) over () as a, "
    "(rank() over (order by user_id) + (count(*) over (partition by user_id) - 1) / 2.0) / count(*) over () as b from events) "
    "select event_id, round(a, 6) as rank_a, round(b, 6) as rank_b, round((a + b) / 2, 6) as mean_rank, round(least(a, b), 6) as unanimous from r",
)
def avg_rank_percentile(spark, folder):
    events = src.table(spark, folder, "events").select("event_id", "value", "user_id")
    ranked = op.average_rank(op.average_rank(events, "value", "a"), "user_id", "b")
    a, b = F.col("a"), F.col("b")
    return ranked.select(
        "event_id",
        F.round(a, 6).alias("rank_a"),
        F.round(b, 6).alias("rank_b"),
        F.round((a + b) / 2, 6).alias("mean_rank"),
        F.round(F.least(a, b), 6).alias("unanimous"),
    )


@catalog.add(
    "median_rank_percentile",
    "with e as (select event_id, value, user_id, event_id % 97 as m from events), "
    + "r as (select event_id, "
    + ", ".join(
        f"(rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0) / count(*) over () as {a}"
        for c, a in (("value", "a"), ("user_id", "b"), ("m", "c"))
    )
    + " from e) select event_id, round(list_median([a, b, c]), 6) as median_rank from r",
)
def median_rank_percentile(spark, folder):
    events = src.table(spark, folder, "events").select("event_id", "value", "user_id", (F.col("event_id") % 97).alias("m"))
    for column, alias in (("value", "a"), ("user_id", "b"), ("m", "c")):
        events = op.average_rank(events, column, alias)
    return events.select("event_id", F.round(op.middle(F.col("a"), F.col("b"), F.col("c")), 6).alias("median_rank"))


_STATUS = {"F": "APPROVED", "O": "DENIED", "P": "NEEDS_REVIEW"}


@catalog.add(
    "threshold_sweep",
    "with h as (select o_totalprice as score, count(*) filter (where o_orderstatus = 'F') as a, count(*) filter (where o_orderstatus = 'O') as d, "
    "count(*) filter (where o_orderstatus = 'P') as r from orders group by 1) "
    "select score, (sum(a) over w)::bigint as approved, (sum(d) over w)::bigint as denied, (sum(r) over w)::bigint as review from h "
    "window w as (order by score desc range between unbounded preceding and current row)",
)
def threshold_sweep(spark, folder):
    label = F.col("o_orderstatus")
    rows = src.table(spark, folder, "orders").select(
        F.col("o_totalprice").alias("score"),
        F.when(label == "F", "APPROVED").when(label == "O", "DENIED").otherwise("NEEDS_REVIEW").alias("actual"),
    )
    swept = op.threshold_sweep(rows, "score", "actual", ("APPROVED", "DENIED", "NEEDS_REVIEW"))
    return swept.select(
        "score",
        F.col("cum_approved").alias("approved"),
        F.col("cum_denied").alias("denied"),
        F.col("cum_needs_review").alias("review"),
    )


_BEST = "((k * 7) % 997) / 996.0 - case when true_adjudication = 'DENIED' then 0.2 else 0.0 end"


@catalog.add(
    "best_threshold",
    PAIRS + f", s as (select true_adjudication as t, round(cast({_BEST} as double), 6) as score from pairs where adjudication = 'NEEDS_REVIEW'), "
    "h as (select score, count(*) filter (where t = 'APPROVED') as a, count(*) filter (where t = 'DENIED') as d, count(*) filter (where t = 'NEEDS_REVIEW') as r from s group by 1), "
    "c as (select score, sum(a) over w as a, sum(d) over w as d, sum(r) over w as r from h window w as (order by score desc)) "
    "select (a - r)::bigint as net, a::bigint as recovered, r::bigint as review_errors, score as threshold from c where d = 0 "
    "order by a - r desc, a desc, r, score desc limit 1",
)
def best_threshold(spark, folder):
    rows = pairs(spark, folder).filter(F.col("adjudication") == "NEEDS_REVIEW")
    scored = rows.withColumn("score", F.expr(f"round(cast({_BEST} as double), 6)"))
    swept = op.threshold_sweep(scored, "score", "true_adjudication", ("APPROVED", "DENIED", "NEEDS_REVIEW"))
    return op.best_threshold(swept, "score")


@catalog.add(
    "hash_split",
    f"select half, count(*) as cases from (select (('0x' || substr(sha256(cast(o_orderkey as varchar)), 1, 8))::ubigint % 2)::bigint as half from orders) group by half",
)
def hash_split(spark, folder):
    orders = src.table(spark, folder, "orders")
    half = op.hash_half(F.col("o_orderkey").cast("string"))
    return orders.groupBy(half.alias("half")).agg(F.count(F.lit(1)).alias("cases"))


@catalog.add(
    "stratified_folds",
    "select o_orderkey, cast((row_number() over (partition by o_orderstatus order by sha256(cast(o_orderkey as varchar))) - 1) % 5 as int) as fold from orders",
)
def stratified_folds(spark, folder):
    orders = src.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return op.stratified_folds(orders, "o_orderkey", "o_orderstatus").select("o_orderkey", "fold")


_COMPLETES = (4, 5, 6, 7, 8, 9)
_DENIALS = (0.05, 0.10, 0.15, 0.20, 0.30, 0.40, 0.49)
_APPROVALS = (0.0, 0.25, 0.50, 0.65, 0.75, 0.85, 0.90)
_COUNT = " + ".join(
    f"({f} not in ('unknown', 'SPN-0000', '1900-01-01'))::int" for f in fixed.FIELDS
)
_ELIGIBLE = (
    "adjudication = 'NEEDS_REVIEW' and risk_flags = 'none' and "
    "(visa_class = 'DIP-1' or sponsor_id not in ('SPN-0000', " + ", ".join(f"'{s}'" for s in fixed.REVOKED_SPONSORS) + "))"
)


def _values(values) -> str:
    return "unnest([" + ", ".join(map(str, values)) + "])"


_SCORED_PAIRS = (
    PAIRS + ", s as (select *, " + ", ".join(f"{v} as {n}" for n, v in SCORES.items())
    + f", {_COUNT} as complete, {_HALF} as half, {_ELIGIBLE} as eligible from pairs)"
)


@catalog.add(
    "grid_route_utility",
    _SCORED_PAIRS
    + f", g as (select * from (select {_values(_COMPLETES)} as minimum_complete), (select {_values(_DENIALS)}::double as denial_max), "
    f"(select {_values(_APPROVALS)}::double as approval_min), (select unnest([false, true]) as require_bio_none)), "
    "c as (select minimum_complete, denial_max, approval_min, require_bio_none, "
    + ", ".join(
        f"count(*) filter (where true_adjudication = '{k}' and half = {h}) as {k.lower()}_{h}"
        for k in sweep.CLASSES for h in (0, 1)
    )
    + " from g left join s on s.eligible and s.complete >= g.minimum_complete and s.denial <= g.denial_max and s.approval >= g.approval_min "
    "and (not g.require_bio_none or s.biometrics) group by all) "
    "select *, least(6 * approved_0 - 7 * needs_review_0, 6 * approved_1 - 7 * needs_review_1) as least_gain, "
    "6 * approved_0 - 7 * needs_review_0 + 6 * approved_1 - 7 * needs_review_1 as total_gain, denied_0 + denied_1 = 0 as safe from c",
)
def grid_route_utility(spark, folder):
    rows = pairs(spark, folder).withColumns({n: F.expr(v) for n, v in SCORES.items()})
    complete = sum(
        (
            F.when(F.col(f).isin("unknown", "SPN-0000", "1900-01-01"), 0).otherwise(1)
            for f in fixed.FIELDS
        ),
        start=F.lit(0),
    )
    rows = rows.select(
        F.expr(_ELIGIBLE).alias("eligible"),
        complete.alias("complete"),
        "denial",
        "approval",
        F.col("biometrics").alias("bio_none"),
        op.hash_half(F.col("case_id")).alias("half"),
        F.col("true_adjudication").alias("actual"),
    )
    return sweep.route_utility(
        rows, completes=_COMPLETES, denial_max=_DENIALS, approval_min=_APPROVALS
    )


_GRID_ORDER = "safe desc, least_gain desc, total_gain desc, minimum_complete, denial_max, approval_min, require_bio_none"


@catalog.add(
    "grid_top_candidates",
    f"select * from ({catalog.checks['grid_route_utility']}) order by {_GRID_ORDER} limit 25",
)
def grid_top_candidates(spark, folder):
    order = [F.desc(c.split()[0]) if " " in c else F.asc(c) for c in _GRID_ORDER.split(", ")]
    return op.top_candidates(grid_route_utility(spark, folder), order, 25)


_PROBS = (0.08, 0.15, 0.30, 0.50, 0.60, 0.80)
_MARGINS = (0.0, 0.05, 0.10, 0.20, 0.30)
_SCOPES = {
    "default": "fee_status = 'unknown'",
    "known": "fee_status <> 'unknown'",
    "all": "true",
}
_PROPOSED = "case when k % 3 = 0 then true_fee_status when k % 3 = 1 then 'paid' else 'waived' end"


@catalog.add(
    "grid_gain_loss",
    _SCORED_PAIRS
    + f", q as (select *, {_PROPOSED} as proposed from s), x as (select * from q where proposed <> fee_status), "
    f"g as (select * from (select {_values(_PROBS)}::double as probability), (select {_values(_MARGINS)}::double as min_margin), (select unnest(['default', 'known', 'all']) as scope)) "
    "select scope, probability, min_margin, coalesce(half::varchar, '(all)') as half, count(*) as changed, "
    "count(*) filter (where proposed = true_fee_status and fee_status <> true_fee_status) as gains, count(*) filter (where fee_status = true_fee_status and proposed <> true_fee_status) as losses, "
    "count(*) filter (where proposed = true_fee_status) - count(*) filter (where fee_status = true_fee_status) as net "
    "from x join g on x.fee_p >= g.probability and x.fee_margin >= g.min_margin and (g.scope = 'all' or (g.scope = 'default') = (x.fee_status = 'unknown')) "
    "group by grouping sets ((scope, probability, min_margin, half), (scope, probability, min_margin))",
)
def grid_gain_loss(spark, folder):
    rows = pairs(spark, folder).withColumns({n: F.expr(v) for n, v in SCORES.items()})
    rows = rows.select(
        op.hash_half(F.col("case_id")).alias("half"),
        F.col("fee_status").alias("current"),
        F.expr(_PROPOSED).alias("proposed"),
        F.col("true_fee_status").alias("actual"),
        F.col("fee_p").alias("probability"),
        F.col("fee_margin").alias("margin"),
    )
    current = F.col("current")
    scopes = {"default": current == "unknown", "known": current != "unknown", "all": F.lit(True)}
    return sweep.gain_loss(
        rows, probabilities=_PROBS, margins=_MARGINS, scopes=scopes, group="half"
    )


@catalog.add(
    "crossfit_bins",
    _SCORED_PAIRS
    + ", b as (select case_id, k % 4 as branch, k % 5 as fold, floor(approval * 5)::int as a, floor(denial * 5)::int as d, same_adjudication::int as correct from s where adjudication = 'NEEDS_REVIEW'), "
    "p as (select x.case_id, count(y.case_id) as n, avg(y.correct) as m from b x left join b y on x.branch = y.branch and x.a = y.a and x.d = y.d and x.fold <> y.fold group by 1), "
    "w as (select x.branch, x.fold, sum(y.s) / sum(y.n) as m from (select distinct branch, fold from b) x join (select branch, fold, sum(correct) as s, count(*) as n from b group by all) y on x.branch = y.branch and x.fold <> y.fold group by all) "
    "select b.case_id, round(case when p.n >= 8 then p.m else w.m end, 6) as estimate from b join p using (case_id) join w on b.branch = w.branch and b.fold = w.fold",
)
def crossfit_bins(spark, folder):
    rows = pairs(spark, folder).withColumns({n: F.expr(v) for n, v in SCORES.items()})
    rows = rows.filter(F.col("adjudication") == "NEEDS_REVIEW").select(
        "case_id",
        (F.col("k") % 4).alias("branch"),
        (F.col("k") % 5).alias("fold"),
        "approval",
        "denial",
        F.col("same_adjudication").alias("correct"),
    )
    return sweep.crossfit_bins(rows, "branch", "fold").select(
        "case_id", F.round("estimate", 6).alias("estimate")
    )


@catalog.add("coordinate_thresholds")
def coordinate_thresholds(spark, folder):
    """Iterative, so rows only; the ascent itself is checked by a test."""
    flags = DEFAULT.flags
    rows = pairs(spark, folder)
    probabilities = {
        f"p_{f}": ((F.col("k") * (7 + 2 * i)) % 101 / 150.0)
        + F.when(F.contains("true_risk_flags", F.lit(f)), 0.33).otherwise(0.0)
        for i, f in enumerate(flags)
    }
    rows = rows.select(
        F.col("risk_flags").alias("current"),
        F.col("true_risk_flags").alias("actual"),
        op.hash_half(F.col("case_id")).alias("half"),
        *[c.alias(n) for n, c in probabilities.items()],
    )
    choices = (0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 1.01)
    chosen, measured = sweep.coordinate_thresholds(rows, flags, choices, "half")
    out = [(f, float(t), *(int(measured[m]) for m in ("gains", "losses", "net"))) for f, t in chosen.items()]
    return spark.createDataFrame(out, "flag string, threshold double, gains long, losses long, net long")
