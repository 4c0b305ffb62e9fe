"""Scans against the truth, value variants, and vocabularies as artefacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia import policy as fixed
from evidentia.operators import scan, snap
from evidentia.plans import bindings as src, sqltext as q
from evidentia.plans.catalog import Catalog
from evidentia.plans.catalog.fuzzy import _top_two
from evidentia.session import shared_path
from evidentia.sources import vocab

catalog = Catalog()
_DEFAULTS = {"sponsor_id": "SPN-0000", "arrival_date": "1900-01-01"}
_HALF = "cast(('0x' || substr(sha256(case_id), 1, 8)) as bigint) % 2"

_PATTERNS = (
    f"{src.cte('readings', src.READINGS)}, "
    r"sp as (select case_id, 'sponsor_id' as field, 'SPN-' || unnest(regexp_extract_all(text, '(?i)\bSPN[- ]?(\d{4})\b', 1)) as value from readings), "
    r"dc as (select case_id, unnest(regexp_extract_all(text, '\b20\d{2}[-/]\d{2}[-/]\d{2}\b')) as raw from readings), "
    f"dd as (select case_id, 'arrival_date' as field, {q.day('raw')} as value from dc), "
    "found as (select case_id, field, count(distinct value) as n, min(value) as sole from (select * from sp union all select * from dd) where value <> '' group by all)"
)


def patterns(spark, folder):
    return scan.unique_patterns(src.readings(spark, folder))


@catalog.add("unique_patterns", f"with {_PATTERNS} select case_id, field, case when n = 1 then sole else '' end as value, n as distinct_values from found")
def unique_patterns(spark, folder):
    return patterns(spark, folder).withColumnRenamed("distinct", "distinct_values")


@catalog.add(
    "scan_crosstab",
    f"with {_PATTERNS}, {src.cte('truth', src.TRUTH)}, {src.cte('predictions', src.PREDICTIONS)}, "
    "c as (select t.case_id, t.adjudication as actual, unnest([{'field': 'sponsor_id', 'truth': t.sponsor_id, 'given': p.sponsor_id, 'd': 'SPN-0000'}, "
    "{'field': 'arrival_date', 'truth': t.arrival_date, 'given': p.arrival_date, 'd': '1900-01-01'}]) as c from truth t join predictions p using (case_id)), "
    f"r as (select c.case_id, actual, c.field, {_HALF.replace('case_id', 'c.case_id')} as half, (c.given = c.d and coalesce(f.n, 0) = 1) as changed, coalesce(f.n = 1 and f.sole = c.truth, false) as fits "
    "from (select case_id, actual, c.field as field, c.truth as truth, c.given as given, c.d as d, c from c) c left join found f on f.case_id = c.case_id and f.field = c.field) "
    "select actual, half::int as half, field, grouping(actual, half, field)::int as \"grouping\", count(*) as cases, count(*) filter (where changed) as changed, "
    "count(*) filter (where changed and fits) as correct, count(*) filter (where changed and not fits) as wrong from r "
    "group by grouping sets ((actual, half, field), (actual, field), (half, field), (field), ())",
)
def scan_crosstab(spark, folder):
    rows = scan.recoveries(patterns(spark, folder), src.bind(spark, folder, src.TRUTH), src.bind(spark, folder, src.PREDICTIONS), _DEFAULTS)
    sets = [["actual", "half", "field"], ["actual", "field"], ["half", "field"], ["field"], []]
    return scan.crosstab(rows, ["actual", "half", "field"], ["changed", "correct", "wrong"], sets)


_VALUES = ", ".join(f"{{'field': '{f}', 'value': {f}}}" for f in fixed.FIELDS)


@catalog.add(
    "value_alternatives",
    f"with {src.cte('truth', src.TRUTH)}, {src.cte('readings', src.READINGS)}, "
    f"v as (select case_id, unnest([{_VALUES}], recursive := true) from truth), "
    "b as (select *, field = 'risk_flags' and value <> 'none' as flagged, case when field = 'risk_flags' and value <> 'none' then [value] || string_split(value, '|') else [value] end as vs from v), "
    "e as (select *, list_filter(case when field in ('species_code', 'risk_flags') then vs || list_transform(vs, lambda x: replace(x, '_', ' ')) else vs end, lambda x: x <> '') as es from b), "
    f"n as (select *, list_transform(es, lambda x: {q.anchor('x')}) as ns from e), "
    "u as (select case_id, field, value, flagged, list_transform(list_filter(range(1, len(ns) + 1), lambda i: not list_contains(ns[1:i - 1], ns[i])), lambda i: ns[i]) as us from n), "
    f"h as (select case_id, {q.anchor('coalesce(text, chr(32))')} as h from readings), "
    "m as (select u.case_id, u.field, array_to_string(us, '|') as variants, case when flagged then len(list_filter(us[1:len(string_split(value, '|'))], lambda x: contains(h, x))) "
    "else (len(list_filter(us, lambda x: x <> '' and contains(h, x))) > 0)::int end as k from u join h using (case_id)) "
    "select case_id, field, variants, count(*) filter (where k > 0) as readings, max(k)::int as found from m group by all",
)
def value_alternatives(spark, folder):
    return scan.value_alternatives(src.readings(spark, folder), src.bind(spark, folder, src.TRUTH), list(fixed.FIELDS))


_CATEGORIES = ("species_code", "home_world", "declared_purpose")


def loaded(spark, folder):
    """The vocabulary of the true values, written as an artefact and loaded from it."""
    path = shared_path(spark, "vocabulary")
    vocab.write_vocabulary(vocab.category_vocabulary(src.bind(spark, folder, src.TRUTH), _CATEGORIES), path)
    return vocab.load_vocabulary(spark, path)


@catalog.add(
    "vocab_load",
    f"with {src.cte('truth', src.TRUTH)} " + " union all ".join(f"select distinct '{f}' as field, {f} as value from truth where {f} <> ''" for f in _CATEGORIES),
)
def vocab_load(spark, folder):
    return loaded(spark, folder)


@catalog.add(
    "snap_indexed",
    f"with recursive {src.cte('predictions', src.PREDICTIONS)}, {src.cte('truth', src.TRUTH)}, "
    + "x as (" + " union all ".join(f"select case_id, '{f}' as field, {f} as v from predictions" for f in _CATEGORIES) + "), "
    + _top_two(
        "select distinct v, regexp_replace(lower(v), '[^a-z0-9]', '', 'g') as a from x",
        "(" + " union ".join(f"select {f} as option, regexp_replace(lower({f}), '[^a-z0-9]', '', 'g') as key from truth" for f in _CATEGORIES) + ")",
    )
    + " select x.case_id, x.field, case when x.v not in ('unknown', '') and n.score >= 0.86 and n.score - n.runner_up >= 0.06 then n.best else x.v end as value "
    "from x join needles d on d.v = x.v join nearest n using (a)",
)
def snap_indexed(spark, folder):
    """Categories against one vocabulary of all fields, by the index instead of a scan of the vocabulary."""
    rows = src.bind(spark, folder, src.PREDICTIONS)
    rows = rows.select("case_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in _CATEGORIES])).alias("r")).select("case_id", "r.*")
    return snap.snap(rows, loaded(spark, folder).select(F.col("value").alias("option")), "value", 0.86, 0.06)
