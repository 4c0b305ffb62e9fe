"""Evidence resolution: consensus, precedence, unique-or-nothing, modes.

Every resolution is an algebraic aggregate (max/min of structs, counts, bit
sets), so partial aggregation shrinks a case before it is shuffled and no
case, however large, is ever collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from evidentia import policy as fixed
from evidentia.functions import fields as fn
from evidentia.operators.extract import source_bit
from evidentia.policy import DEFAULT, Policy

CONSENSUS_FIELDS = ("applicant_name", "species_code", "sponsor_id")


def visa_bit(value: Column) -> Column:
    """Bit of a visa spelling; visas are a closed set with or without hyphen."""
    bit = F.lit(0)
    for position, name in enumerate(fixed.VISA_CLASSES):
        bit = F.when(value == name, F.lit(1 << (2 * position))).when(
            value == name.replace("-", ""), F.lit(2 << (2 * position))
        ).otherwise(bit)
    return bit


def singleton(value: str | Column) -> Column:
    """The only distinct value of a group, else NULL."""
    column = F.col(value) if isinstance(value, str) else value
    return F.when(F.min(column) == F.max(column), F.min(column))


def modes(value: str) -> tuple[Column, Column]:
    """Aggregates over (reads, value) rows that :func:`mode_of` reads."""
    return (
        F.max(F.struct("reads", F.col(value).alias("value"))).alias("mode"),
        F.min(F.struct((-F.col("reads")).alias("reads"), F.col(value).alias("value"))).alias("mode_rival"),
    )


def mode_without_tie(df: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """Most frequent value per key, '' when two values share the top count."""
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("reads"))
    packed = counted.groupBy(*keys).agg(*modes(value)).select(*keys, F.struct("mode", "mode_rival").alias("s"))
    return packed.select(*keys, F.coalesce(mode_of(F.col("s")), F.lit("")).alias(alias))


def precedence_winner(weight: str, source: str, order: list[str], value: str) -> Column:
    """Value of highest (weight, source); among equals the earliest emitted."""
    return F.max_by(
        F.col(value), F.struct(weight, source, *[(-F.col(c)).alias(f"minus_{c}") for c in order])
    )


def value_summary(facts: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (keys, value): reads, distinct sources, best provenance."""
    return facts.groupBy(*keys, "value").agg(
        F.count(F.lit(1)).alias("reads"),
        F.bit_count(F.bit_or(source_bit(F.col("source")))).alias("sources"),
        F.max("weight").alias("weight"),
        F.max(
            F.struct(
                "weight",
                "source",
                (-F.col("page")).alias("minus_page"),
                (-F.col("reading_no")).alias("minus_reading"),
                (-F.col("ordinal")).alias("minus_ordinal"),
            )
        ).alias("best"),
        F.max((F.col("source") == "biometric").cast("int")).alias("biometric"),
        F.max(F.col("source").isin("intake", "sponsor").cast("int")).alias("filed"),
    )


def fact_summary(values: DataFrame, keys: list[str], policy: Policy = DEFAULT) -> DataFrame:
    """One row per group of values, holding what every resolution rule needs."""
    adverse = F.when(F.col("value") != "none", fn.flag_mask(F.col("value"), policy)).otherwise(F.lit(0))
    return values.groupBy(*keys).agg(
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.max(F.struct("sources", "reads", "weight", "value")).alias("top"),
        F.min(
            F.struct((-F.col("sources")).alias("sources"), (-F.col("reads")).alias("reads"), "value")
        ).alias("rival"),
        F.max(F.struct("sources", "reads", "value")).alias("peak"),
        *modes("value"),
        F.max_by("value", "best").alias("preferred"),
        F.bit_or(adverse).alias("adverse"),
        F.max(F.when(F.col("value") == "none", F.col("biometric"))).alias("biometric_none"),
        F.bit_or(F.when(F.col("filed") == 1, visa_bit(F.col("value"))).otherwise(F.lit(0))).alias("filed_visas"),
    )


def only(summary: Column) -> Column:
    """Unique-or-nothing on a ``fact_summary`` struct: NULL unless singleton."""
    return F.when(summary["low"] == summary["high"], summary["low"])


def mode_of(summary: Column) -> Column:
    return F.when(summary["mode"]["value"] == summary["mode_rival"]["value"], summary["mode"]["value"])


def consensus(summary: Column, valid: Column | None = None) -> Column:
    """Value with the most sources, then reads, unless the two are tied or thin.

    ``peak`` and ``rival`` are the last and the first value among those with
    the top (sources, reads); they coincide exactly when there is no tie.
    """
    top = summary["top"]
    accept = ((top["sources"] >= 2) | (top["reads"] >= 3)) & (
        summary["peak"]["value"] == summary["rival"]["value"]
    )
    if valid is not None:
        accept = accept & valid
    return F.when(accept, top["value"])


def choose(field: str, summary: Column, policy: Policy = DEFAULT) -> Column:
    """Resolved value of one field from its summary; the sentinel without evidence."""
    sentinel = F.lit(fixed.SENTINELS[field])
    if field == "risk_flags":
        union = fn.flags_of_mask(summary["adverse"], policy)
        chosen = F.when(summary["adverse"] != 0, union).otherwise(summary["preferred"])
    elif field in CONSENSUS_FIELDS:
        valid = summary["top"]["value"].isin(*policy.species) if field == "species_code" else None
        chosen = F.coalesce(consensus(summary, valid), summary["preferred"])
    else:
        chosen = summary["preferred"]
    return F.coalesce(chosen, sentinel)


def resolve_evidence(evidence: DataFrame, policy: Policy = DEFAULT, by: tuple[str, ...] = ("case_id", "channel", "field")) -> DataFrame:
    """Resolved value per (case, channel, field) of typed evidence rows."""
    summary = fact_summary(value_summary(evidence, list(by)), list(by), policy)
    columns = [c for c in summary.columns if c not in by]
    packed = summary.select(*by, F.struct(*columns).alias("s"))
    resolved = F.lit(None).cast("string")
    for name in fixed.FIELDS:
        resolved = F.when(F.col("field") == name, choose(name, F.col("s"), policy)).otherwise(resolved)
    return packed.filter(F.col("field").isin(*fixed.FIELDS)).select(*by, resolved.alias("value"))


def finding(manual: Column, denied: Column, review: Column) -> tuple[Column, Column]:
    """(finding, agreed manual finding) of a case.

    One distinct manual finding decides; several mean review; without any, a
    denial on a note page outranks a review on one.
    """
    agreed = only(manual)
    chosen = (
        F.when(agreed.isNotNull(), agreed)
        .when(manual["low"].isNotNull(), F.lit("NEEDS_REVIEW"))
        .when(denied, F.lit("DENIED"))
        .when(review, F.lit("NEEDS_REVIEW"))
        .otherwise("")
    )
    return chosen, F.coalesce(agreed, F.lit(""))


def finding_resolution(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Finding per case from rows with ``manual`` and ``note`` columns ('' = none)."""
    manual = F.nullif(F.col("manual"), F.lit(""))
    agg = rows.groupBy(*keys).agg(
        F.min(manual).alias("low"),
        F.max(manual).alias("high"),
        F.bool_or(F.col("note") == "DENIED").alias("denied"),
        F.bool_or(F.col("note") == "NEEDS_REVIEW").alias("review"),
    )
    chosen, _ = finding(F.struct("low", "high"), F.col("denied"), F.col("review"))
    return agg.select(*keys, chosen.alias("finding"))


def resolve_ledger(candidates: DataFrame, keys: tuple[str, ...] = ("case_id", "field")) -> DataFrame:
    """Winner, reason and conflicts per field of crop readings.

    The winner has the best (anchor, ocr) quality, the earliest among equals;
    ``seq`` is the reading order. Conflicting values are bounded by the crops
    read per field and are kept, never discarded.
    """
    keys = list(keys)
    per_value = (
        candidates.filter(F.col("normalized_value") != "")
        .groupBy(*keys, "normalized_value")
        .agg(
            F.count(F.lit(1)).alias("reads"),
            F.max(F.struct("anchor_quality", "ocr_quality", (-F.col("seq")).alias("minus_seq"))).alias("best"),
        )
    )
    valid = per_value.groupBy(*keys).agg(
        F.sum("reads").alias("valid_reads"),
        F.max_by("normalized_value", "best").alias("selected_value"),
        F.array_sort(F.collect_set("normalized_value")).alias("every"),
    )
    all_keys = candidates.groupBy(*keys).agg(F.count(F.lit(1)).alias("candidates"))
    joined = all_keys.join(valid, keys, "left")
    return joined.select(
        *keys,
        "candidates",
        F.coalesce("selected_value", F.lit("")).alias("selected_value"),
        F.when(F.col("selected_value").isNull(), "no_valid_candidate")
        .when((F.col("valid_reads") > 1) & (F.size("every") == 1), "corroborated_equivalent_readings")
        .otherwise("highest_anchor_then_ocr_quality")
        .alias("resolution_reason"),
        F.coalesce(
            F.filter("every", lambda v: v != F.col("selected_value")), F.array().cast("array<string>")
        ).alias("conflicts"),
    )


def corroborated_sponsor(candidates: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Sponsor id read alike from two crops at full quality, with no dissent."""
    valid = F.nullif(F.col("normalized_value"), F.lit(""))
    strong = (
        valid.isNotNull()
        & (F.col("anchor_quality") == 1.0)
        & (F.col("ocr_quality") >= policy.roi_quality)
        & (F.array_join("transform_chain", "+") == "crop+native")
    )
    crop = F.when(strong, F.col("crop"))
    agg = candidates.filter(F.col("field") == "sponsor_id").groupBy("case_id").agg(
        F.min(valid).alias("low"),
        F.max(valid).alias("high"),
        F.min(crop).alias("first_crop"),
        F.max(crop).alias("last_crop"),
    )
    accept = (F.col("low") == F.col("high")) & (F.col("first_crop") != F.col("last_crop"))
    return agg.select("case_id", F.when(accept, F.col("low")).otherwise("").alias("sponsor_id"))


def agreed_fee_band(candidates: DataFrame) -> DataFrame:
    """Fee state when every valid reading of the fee band agrees."""
    good = (
        (F.col("reader_family") == "top_left_fee_band")
        & (F.col("anchor_quality") == 1.0)
        & (F.col("normalized_value") != "")
    )
    return (
        candidates.filter(good)
        .groupBy("case_id")
        .agg(F.coalesce(singleton("normalized_value"), F.lit("")).alias("fee_status"))
    )
