"""Scans of whole readings against the truth: unique patterns, cross-tabs, value variants.

A value counts for a case if it is the only one of its kind in all its
readings: smallest and largest found are the same, so partial aggregation
settles it and no set of values is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from evidentia.functions import fields as fn, text as tx
from evidentia.operators.rank import hash_half

SPONSOR = r"(?i)\bSPN[- ]?(\d{4})\b"
DAY = r"\b20\d{2}[-/]\d{2}[-/]\d{2}\b"


def unique_patterns(readings: DataFrame) -> DataFrame:
    """(case_id, field, value, distinct): what sponsors and dates the readings of a case show.

    ``value`` is empty unless exactly one was found. A case without any has no row.
    """
    sponsors = F.transform(F.regexp_extract_all("text", F.lit(SPONSOR), F.lit(1)), lambda d: F.concat(F.lit("SPN-"), d))
    days = F.transform(F.regexp_extract_all("text", F.lit(DAY), F.lit(0)), fn.clean_date)
    pair = lambda name, values: F.transform(values, lambda v: F.struct(F.lit(name).alias("field"), v.alias("value")))
    found = F.array_distinct(F.concat(pair("sponsor_id", sponsors), pair("arrival_date", days)))
    rows = readings.select("case_id", F.explode(found).alias("f")).select("case_id", "f.*").filter(F.col("value") != "")
    kinds = rows.distinct().groupBy("case_id", "field").agg(F.count(F.lit(1)).alias("distinct"), F.min("value").alias("only"))
    return kinds.select("case_id", "field", F.when(F.col("distinct") == 1, F.col("only")).otherwise("").alias("value"), "distinct")


def recoveries(patterns: DataFrame, truth: DataFrame, predictions: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """One row per case and field: class, half, and whether a missing value changed, rightly or wrongly."""
    fields = list(defaults)
    pairs = truth.alias("t").join(predictions.alias("p"), "case_id")
    cells = [F.struct(F.lit(f).alias("field"), F.col(f"t.{f}").alias("truth"), F.col(f"p.{f}").alias("given"), F.lit(d).alias("default")) for f, d in defaults.items()]
    rows = pairs.select("case_id", F.col("t.adjudication").alias("actual"), F.explode(F.array(*cells)).alias("c")).select("case_id", "actual", "c.*")
    rows = rows.join(patterns.filter(F.col("field").isin(fields)).select("case_id", "field", "value"), ["case_id", "field"], "left")
    changed = (F.col("given") == F.col("default")) & (F.coalesce("value", F.lit("")) != "")
    right = F.coalesce(F.col("value") == F.col("truth"), F.lit(False))
    return rows.select(
        "case_id", "field", "actual", hash_half(F.col("case_id")).cast("int").alias("half"),
        changed.alias("changed"), (changed & right).alias("correct"), (changed & ~right).alias("wrong"),
    )


def crosstab(rows: DataFrame, dimensions: list[str], measures: list[str], sets: list[list[str]]) -> DataFrame:
    """Counts of true ``measures`` for several sets of dimensions in one aggregation.

    ``grouping`` has a bit for each dimension (first one highest) that a row
    sums over, so its nulls differ from null values.
    """
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dimensions])
    return grouped.agg(
        F.grouping_id(*dimensions).cast("int").alias("grouping"),
        F.count(F.lit(1)).alias("cases"),
        *[F.count_if(m).alias(m) for m in measures],
    )


def alternatives(field: Column, value: Column) -> Column:
    """Variants of a value as anchor text, in order and once each: itself, its flags, with spaces for underscores."""
    flags = F.when((field == "risk_flags") & (value != "none"), F.split(value, r"\|")).otherwise(F.array().cast("array<string>"))
    values = F.concat(F.array(value), flags)
    spaced = F.when(field.isin("species_code", "risk_flags"), F.transform(values, lambda v: F.replace(v, F.lit("_"), F.lit(" "))))
    every = F.concat(values, F.coalesce(spaced, F.array().cast("array<string>")))
    return F.array_distinct(F.transform(F.filter(every, lambda v: v != ""), tx.anchor_text))


def matches(haystack: Column, field: Column, value: Column, variants: Column) -> Column:
    """How much of a value an anchor text holds: 0 or 1, for flags the number of the first variants, one a flag."""
    hits = F.transform(variants, lambda v: (F.contains(haystack, v) & ((v != "") | ((field == "risk_flags") & (value != "none")))).cast("int"))
    flags = F.slice(hits, 1, F.size(F.split(value, r"\|")))
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    return F.when((field == "risk_flags") & (value != "none"), total(flags)).otherwise(F.coalesce(F.array_max(hits), F.lit(0)))


def value_alternatives(readings: DataFrame, truth: DataFrame, fields: list[str]) -> DataFrame:
    """(case_id, field, variants, readings, found): variants of each true value, readings that hold one, the most held at once.

    Each reading meets the values of its case once; its text is folded once.
    """
    values = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(f, F.lit("")).alias("value")) for f in fields])
    told = F.transform(values, lambda s: F.struct(s["field"], s["value"], alternatives(s["field"], s["value"]).alias("variants")))
    texts = readings.select("case_id", tx.anchor_text(F.coalesce("text", F.lit(""))).alias("haystack"))
    met = truth.select("case_id", told.alias("values")).join(texts, "case_id")
    hits = F.transform("values", lambda s: F.struct(s["field"], F.array_join(s["variants"], "|").alias("variants"), matches(F.col("haystack"), s["field"], s["value"], s["variants"]).alias("n")))
    rows = met.select("case_id", F.explode(hits).alias("h")).select("case_id", "h.*")
    return rows.groupBy("case_id", "field", "variants").agg(F.count_if(F.col("n") > 0).alias("readings"), F.max("n").alias("found"))
