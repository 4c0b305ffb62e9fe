"""Decision rules and recovery gates over prediction records."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia import policy as fixed
from evidentia.operators import decide as op
from evidentia.plans import adjudicate as plan, bindings as src
from evidentia.plans.catalog import Catalog

catalog = Catalog()
PREDICTIONS = f"with {src.cte('predictions', src.PREDICTIONS)}"


def record():
    return {n: F.col(n) for n in fixed.FIELDS}


def _listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_DISQUALIFIED = f"len(list_intersect(string_split(risk_flags, '|'), [{_listed(fixed.DISQUALIFYING_FLAGS)}])) > 0"
_REVIEWED = f"len(list_intersect(string_split(risk_flags, '|'), [{_listed(fixed.REVIEW_FLAGS)}])) > 0"
_STALE = (
    "(try_cast(arrival_date as date) is not null and date_diff('day', try_cast(arrival_date as date), date '2026-07-07') > 180 "
    "and arrival_date <> '1900-01-01' and visa_class not in ('unknown', 'DIP-1') and k % 2 = 0)"
)
#: Facts a case brings besides its record, derived from its key.
FACTS = {
    "finding": "case when k % 29 = 1 then 'DENIED' when k % 29 = 2 then 'NEEDS_REVIEW' else '' end",
    "biometrics": "k % 3 <> 0",
    "approved": "k % 37 = 4",
    "reviewed": "k % 41 = 5",
    "noted": "k % 11 = 6",
}


@catalog.add(
    "decide_cascade",
    PREDICTIONS
    + ", f as (select *, " + ", ".join(f"{v} as {n}" for n, v in FACTS.items()) + f", {_STALE} as stale from predictions), "
    "r as (select *, case when reviewed then 1 when approved and risk_flags = 'none' then 2 "
    f"when finding = 'DENIED' or {_DISQUALIFIED} or fee_status = 'unpaid' or visa_class = 'TRANSIT-7' then 3 "
    f"when finding = 'NEEDS_REVIEW' or {_REVIEWED} then 4 when stale then 5 "
    f"when visa_class not in ('unknown', 'DIP-1') and (sponsor_id in ({_listed(fixed.STRICT_SPONSORS)}) or (sponsor_id = 'SPN-4040' and fee_status = 'paid')) then 6 "
    "when visa_class = 'unknown' or arrival_date = '1900-01-01' or fee_status = 'unknown' then 7 "
    f"when visa_class <> 'DIP-1' and sponsor_id in ('SPN-0000', {_listed(fixed.REVOKED_SPONSORS)}) then 8 "
    "when fee_status = 'waived' and visa_class <> 'DIP-1' then 9 "
    "when biometrics and fee_status = 'paid' and not noted then 10 else 11 end as rule from f) "
    "select case_id, cast(rule as int) as rule, case when rule in (2, 10) then 'APPROVED' when rule in (3, 5, 6) then 'DENIED' else 'NEEDS_REVIEW' end as decision, "
    "cast(case rule when 1 then 0.99 when 2 then 0.98 when 3 then 0.97 when 4 then 0.99 when 5 then 0.97 when 6 then 0.97 when 7 then 0.47 "
    "when 8 then 0.0 when 9 then 0.42 when 10 then 0.98 else 0.39 end as double) as confidence from r",
)
def decide_cascade(spark, folder):
    rows = src.bind(spark, folder, src.PREDICTIONS).withColumns({n: F.expr(v) for n, v in FACTS.items()})
    stale = (
        op.stale_arrival(F.col("arrival_date"))
        & (F.col("arrival_date") != fixed.SENTINELS["arrival_date"])
        & ~F.col("visa_class").isin("unknown", "DIP-1")
        & (F.col("k") % 2 == 0)
    )
    outcome = op.decide(
        record(),
        finding=F.col("finding"),
        clean_biometrics=F.col("biometrics"),
        manual_approval=F.col("approved"),
        manual_review=F.col("reviewed"),
        stale=stale,
        unresolved_note=F.col("noted"),
    )
    return rows.select("case_id", outcome.alias("o")).select("case_id", "o.rule", "o.decision", "o.confidence")


@catalog.add(
    "stale_arrival",
    PREDICTIONS
    + " select case_id, coalesce(date_diff('day', try_cast(arrival_date as date), date '2026-07-07') > 180, false) as stale from predictions",
)
def stale_arrival(spark, folder):
    rows = src.bind(spark, folder, src.PREDICTIONS)
    return rows.select("case_id", op.stale_arrival(F.col("arrival_date")).alias("stale"))


_SPONSOR_OK = f"(visa_class = 'DIP-1' or (regexp_full_match(sponsor_id, 'SPN-[0-9]{{4}}') and sponsor_id not in ({_listed(fixed.REVOKED_SPONSORS)})))"
_FEE_OK = "(fee_status = 'paid' or (fee_status = 'waived' and visa_class = 'DIP-1'))"
_VISA_OK = f"visa_class in ({_listed(fixed.APPROVABLE_VISAS)})"


def _complete(*ignored: str) -> str:
    return "(" + " and ".join(f"{f} <> '{s}'" for f, s in fixed.SENTINELS.items() if f not in ignored) + ")"


@catalog.add(
    "completeness",
    PREDICTIONS
    + f" select {_complete('risk_flags')} as complete, {_complete('risk_flags', 'fee_status')} as complete_but_fee, {_FEE_OK} as fee_ok, "
    f"{_SPONSOR_OK} as sponsor_ok, count(*) as cases from predictions group by all",
)
def completeness(spark, folder):
    rows = src.bind(spark, folder, src.PREDICTIONS)
    return rows.groupBy(
        op.complete(record()).alias("complete"),
        op.complete(record(), ("risk_flags", "fee_status")).alias("complete_but_fee"),
        op.fee_ok(F.col("fee_status"), F.col("visa_class")).alias("fee_ok"),
        op.sponsor_ok(F.col("sponsor_id"), F.col("visa_class")).alias("sponsor_ok"),
    ).agg(F.count(F.lit(1)).alias("cases"))


SCORES = {
    "approval": "cast((k * 7) % 101 as double) / 100.0",
    "denial": "cast((k * 11) % 97 as double) / 96.0",
    "fee_p": "cast((k * 5) % 89 as double) / 88.0",
    "fee_margin": "cast((k * 3) % 83 as double) / 164.0",
    "biometrics": "k % 3 <> 0",
}
_SCORED = PREDICTIONS + ", s as (select *, " + ", ".join(f"{v} as {n}" for n, v in SCORES.items()) + " from predictions)"


@catalog.add(
    "paired_gate",
    _SCORED
    + f" select case_id from s where risk_flags = 'none' and {_complete('risk_flags')} and {_FEE_OK} and {_SPONSOR_OK} and {_VISA_OK} "
    "and ((approval >= 0.75 and denial <= 0.3) or (biometrics and approval >= 0.5 and denial <= 0.4))",
)
def paired_gate(spark, folder):
    rows = src.bind(spark, folder, src.PREDICTIONS).withColumns({n: F.expr(v) for n, v in SCORES.items()})
    gate = op.paired_gate(record(), F.col("approval"), F.col("denial"), F.col("biometrics"))
    return rows.filter(gate).select("case_id")


@catalog.add(
    "modeled_fee_gate",
    _SCORED
    + f" select case_id from s where fee_status = 'unknown' and risk_flags = 'none' and {_complete('risk_flags', 'fee_status')} and "
    f"(k % 2 = 0 or visa_class = 'DIP-1') and {_SPONSOR_OK} and {_VISA_OK} and biometrics and fee_p >= 0.3 and fee_margin >= 0.19 and approval >= 0.7 and denial <= 0.6",
)
def modeled_fee_gate(spark, folder):
    rows = src.bind(spark, folder, src.PREDICTIONS).withColumns({n: F.expr(v) for n, v in SCORES.items()})
    gate = op.modeled_fee_gate(
        record(),
        fee_value=F.when(F.col("k") % 2 == 0, "paid").otherwise("waived"),
        fee_probability=F.col("fee_p"),
        fee_margin=F.col("fee_margin"),
        approval=F.col("approval"),
        denial=F.col("denial"),
        biometrics=F.col("biometrics"),
    )
    return rows.filter(gate).select("case_id")


@catalog.add(
    "risk_denial_recovery",
    f"with {src.cte('truth', src.TRUTH)}, {src.cte('predictions', src.PREDICTIONS)} select p.case_id from predictions p join truth t using (case_id) "
    f"where p.adjudication = 'NEEDS_REVIEW' and len(list_intersect(string_split(t.risk_flags, '|'), [{_listed(fixed.DISQUALIFYING_FLAGS)}])) > 0",
)
def risk_denial_recovery(spark, folder):
    modeled = src.bind(spark, folder, src.TRUTH).select("case_id", F.col("risk_flags").alias("modeled"))
    rows = src.bind(spark, folder, src.PREDICTIONS).join(modeled, "case_id")
    return rows.filter(op.risk_denial(F.col("adjudication"), F.col("modeled"))).select("case_id")


@catalog.add(
    "learned_overrides",
    _SCORED
    + " select adjudication, final, count(*) as cases from (select adjudication, case when adjudication <> 'NEEDS_REVIEW' or k % 41 = 5 then adjudication "
    "when denial >= 0.5 then 'DENIED' when approval >= 0.9 then 'APPROVED' else adjudication end as final from s) group by all",
)
def learned_overrides(spark, folder):
    rows = src.bind(spark, folder, src.PREDICTIONS).withColumns({n: F.expr(v) for n, v in SCORES.items()})
    rows = rows.withColumns({"first": F.col("adjudication"), "confidence": F.lit(0.0)})
    still_open = (F.col("adjudication") == "NEEDS_REVIEW") & (F.col("k") % 41 != 5)
    rows = plan.settle(rows, still_open, (F.col("denial") >= 0.5, "DENIED", 0.87), (F.col("approval") >= 0.9, "APPROVED", 0.97))
    return rows.groupBy(F.col("first").alias("adjudication"), F.col("adjudication").alias("final")).agg(F.count(F.lit(1)).alias("cases"))
