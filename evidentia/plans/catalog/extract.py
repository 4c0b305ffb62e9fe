"""Extraction from readings, reading by reading and folded per case."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia import policy as fixed
from evidentia.functions import fields as fn, text as tx
from evidentia.operators import extract as op, resolve
from evidentia.plans import bindings as src, sqltext as q
from evidentia.plans.catalog import Catalog
from evidentia.policy import DEFAULT

catalog = Catalog()
READINGS = f"with {src.cte('readings', src.READINGS)}"
KEYS = ("case_id", "page", "reading_no", "channel")
KEY_SQL = ", ".join(KEYS)


@catalog.add("page_kind_argmax", f"{READINGS} select {KEY_SQL}, {q.kind('text')} as kind from readings")
def page_kind_argmax(spark, folder):
    return src.readings(spark, folder).select(*KEYS, op.page_kind(F.col("text")).alias("kind"))


@catalog.add(
    "label_next_row",
    f"{READINGS}, r as (select *, {q.rows('text')} as rws from readings) select {KEY_SQL}, "
    "coalesce(rws[list_filter(range(1, len(rws)), lambda i: regexp_full_match(rws[i], '(?i)Species(?: Code)? ?:?'))[1] + 1], '') as value "
    "from r",
)
def label_next_row(spark, folder):
    rows = tx.rows_text(F.col("text"))
    return src.readings(spark, folder).select(
        *KEYS, tx.label_next_row(rows, "Species(?: Code)?").alias("value")
    )


@catalog.add(
    "label_inline",
    f"{READINGS} select {KEY_SQL}, trim({q.norm(chr(34) + 'v' + chr(34))}, ' .,:;') as value from (select *, "
    "regexp_extract(text, '(?i)\\bHome World[ \\t]*:?[ \\t]*([^|;\\n]{1,90})', 1) as v from readings)",
)
def label_inline(spark, folder):
    return src.readings(spark, folder).select(
        *KEYS, tx.label_inline(F.col("text"), "Home World").alias("value")
    )


@catalog.add(
    "value_before_label",
    f"{READINGS}, r as (select *, {q.rows('text')} as rws from readings) select {KEY_SQL}, "
    f"{q.above('rws', 'Applicant', q.name)} as value from r",
)
def value_before_label(spark, folder):
    rows = src.readings(spark, folder).withColumn("row_array", tx.rows(F.col("text")))
    return rows.select(
        *KEYS, tx.value_before_label(F.col("row_array"), "Applicant", fn.clean_name).alias("value")
    )


@catalog.add(
    "evidence_rows",
    f"{READINGS}, {q.evidence()} select field, source, value, channel, count(*) as reads from evidence group by all",
)
def evidence_rows(spark, folder):
    rows = op.evidence(src.readings(spark, folder), fuzzy=False)
    return rows.groupBy("field", "source", "value", "channel").agg(F.count(F.lit(1)).alias("reads"))


@catalog.add(
    "manual_finding",
    f"{READINGS} select {KEY_SQL}, finding from (select *, {q.finding('text', 'Finding\\s*:\\s*')} as finding "
    "from readings) where finding <> ''",
)
def manual_finding(spark, folder):
    found = src.readings(spark, folder).select(*KEYS, op.manual_finding(F.col("text")).alias("finding"))
    return found.filter(F.col("finding") != "")


_FIX = {
    "applicant_name": ("applicant\\s+is", "[A-Z][A-Za-z]{2,20}\\s+[A-Z][A-Za-z]{2,20}", q.name),
    "sponsor_id": ("sponsor\\s+is", "SPN[- ]?[0-9]{4}", q.sponsor),
    "visa_class": ("visa\\s+class\\s+is", fixed.VISA_PATTERN, lambda x: f"replace(upper({x}), ' ', '-')"),
    "fee_status": ("fee\\s+status\\s+is", "paid|unpaid|waived", lambda x: f"lower({x})"),
}


def _fix_sql(subject: str, value: str, clean) -> str:
    return clean(
        f"regexp_extract(text, '(?i)\\bManual\\s+correction\\s*:\\s*{subject}\\s+({value})\\b', 1)"
    )


@catalog.add(
    "manual_corrections",
    f"{READINGS} select * from ("
    + " union all ".join(
        f"select {KEY_SQL}, '{n}' as field, {_fix_sql(*f)} as value from readings" for n, f in _FIX.items()
    )
    + ") where value <> ''",
)
def manual_corrections(spark, folder):
    read = src.readings(spark, folder).select(
        *KEYS, *[v.alias(n) for n, v in op.manual_corrections(F.col("text")).items()]
    )
    long = read.unpivot(list(KEYS), list(_FIX), "field", "value")
    return long.filter(F.col("value") != "")


_SENTENCE = (
    "(?is)\\bSponsor\\s+(SPN[- ]?[0-9]{4})\\s+attests\\s+that\\s+"
    "([A-Z][A-Za-z]{2,20}\\s+[A-Z][A-Za-z]{2,20})\\s+is\\s+expected\\b(.*)"
)
_PURPOSES = ", ".join(f"'{p}'" for p in fixed.PURPOSES)


@catalog.add(
    "attested_details",
    f"{READINGS}, s as (select {KEY_SQL}, regexp_extract(text, '{_SENTENCE}', 1) as sp, "
    f"regexp_extract(text, '{_SENTENCE}', 2) as ap, substr(regexp_extract(text, '{_SENTENCE}', 3), 1, 600) as rest "
    "from readings where regexp_matches(text, '" + _SENTENCE + "')), "
    f"p as (select *, lower({q.norm(chr(34) + 'raw' + chr(34))}) as said from (select *, regexp_extract(rest, '(?i)^\\s+on\\s+Earth\\s+for\\s+([^.\\n]{{2,40}})\\.', 1) as raw from s)) "
    f"select {KEY_SQL}, {q.sponsor('sp')} as sponsor, {q.name('ap')} as applicant, "
    f"case when said in ({_PURPOSES}) then said else '' end as purpose, "
    f"replace(upper(regexp_extract(rest, '(?i)\\bresponsibility\\s+for\\s+class\\s+({fixed.VISA_PATTERN})\\s+compliance\\b', 1)), ' ', '-') as visa from p",
)
def attested_details(spark, folder):
    found = src.readings(spark, folder).select(
        *KEYS, *[v.alias(n) for n, v in op.attestation(F.col("text")).items()]
    )
    return found.filter(F.col("sponsor") != "")


def _category_sql() -> str:
    arms = []
    for field, options in DEFAULT.vocabulary.items():
        gate = " and kind in ('intake', 'sponsor')" if field == "declared_purpose" else ""
        for option in options:
            key = op._anchor(option)
            arms.append(
                f"select {KEY_SQL}, '{field}' as field, '{option}' as value from folded where contains(f, ' {key} '){gate}"
            )
    return (
        f"folded as materialized (select *, ' ' || {q.anchor('text')} || ' ' as f, {q.kind('text')} as kind from readings), "
        "hits as (" + " union all ".join(arms) + ")"
    )


@catalog.add(
    "category_containment",
    f"{READINGS}, {_category_sql()} select case_id, field, min(value) as first_value, count(distinct value) as hits, "
    "case when min(value) = max(value) then min(value) else '' end as only_value from hits group by case_id, field",
)
def category_containment(spark, folder):
    read = src.readings(spark, folder).withColumn("kind", op.page_kind(F.col("text")))
    read = read.select("case_id", "kind", op.padded(F.col("text")).alias("words"))
    masks = op.category_masks(F.col("words"), F.col("kind"))
    return op.category_summary(read.select("case_id", *[v.alias(n) for n, v in masks.items()]))


@catalog.add(
    "adverse_flags_excluding_instructions",
    f"{READINGS}, kept as (select case_id, unnest({q.lines('text')}) as line from readings), "
    f"folded as (select case_id, replace(replace({q.fold('line')}, '-', '_'), ' ', '_') as f from kept "
    "where not regexp_matches(line, '(?i)\\b(barcode|payload|force|ignore|answer|adjudication)\\b')), "
    "found as (" + " union all ".join(
        f"select case_id, '{f}' as flag from folded where contains(f, '{f}')" for f in DEFAULT.flags
    ) + ") select case_id, string_agg(flag, '|' order by flag) as flags from (select distinct case_id, flag from found) group by case_id",
)
def adverse_flags_excluding_instructions(spark, folder):
    read = src.readings(spark, folder).select("case_id", op.adverse_flags(F.col("text")).alias("flags"))
    mask = F.bit_or(fn.flag_mask(F.col("flags")))
    folded = read.filter(F.col("flags") != "").groupBy("case_id").agg(mask.alias("mask"))
    return folded.select("case_id", fn.flags_of_mask(F.col("mask")).alias("flags"))


@catalog.add(
    "iso_dates_unique",
    f"{READINGS}, d as (select case_id, unnest(regexp_extract_all(text, '\\b20[0-9][0-9]-[0-9][0-9]-[0-9][0-9]\\b')) as d from readings), "
    "v as (select case_id, d from d where try_cast(d as date) is not null and year(try_cast(d as date)) between 2025 and 2026) "
    "select case_id, case when count(distinct d) = 1 then min(d) else '' end as arrival from v group by case_id",
)
def iso_dates_unique(spark, folder):
    dates = src.readings(spark, folder).select(
        "case_id", F.explode_outer(fn.iso_dates(F.col("text"))).alias("d")
    )
    return (
        dates.filter(F.col("d").isNotNull())
        .groupBy("case_id")
        .agg(F.coalesce(resolve.singleton("d"), F.lit("")).alias("arrival"))
    )


@catalog.add(
    "date_glyph_repair",
    f"{READINGS}, l as (select case_id, unnest({q.lines('text')}) as line from readings), "
    "m as (select case_id, unnest(regexp_extract_all(line, '\\b2028[-/]([0-9][0-9][-/]?[0-9][0-9])\\b', 1)) as md from l "
    "where regexp_matches(line, '(?i)\\ba[a-z]{2,12}\\s+d[a-z]{2,6}\\b')), "
    "r as (select case_id, '2026-' || case when left(md, 2) = '08' then '06' else left(md, 2) end || '-' || right(md, 2) as d from m) "
    "select case_id, case when count(distinct d) = 1 then min(d) else '' end as arrival from r "
    "where try_cast(d as date) is not null group by case_id",
)
def date_glyph_repair(spark, folder):
    dates = src.readings(spark, folder).select(
        "case_id", F.explode_outer(fn.damaged_dates(F.col("text"))).alias("d")
    )
    return (
        dates.filter(F.col("d").isNotNull())
        .groupBy("case_id")
        .agg(F.coalesce(resolve.singleton("d"), F.lit("")).alias("arrival"))
    )


@catalog.add(
    "label_score",
    f"{READINGS} select case_id, page, cast(("
    + " + ".join(f"max(contains({q.anchor('text')}, '{w}')::int)" for w in fixed.ORIENTATION_LABELS)
    + ") as bigint) as labels from readings where channel = 'native' group by case_id, page",
)
def label_score(spark, folder):
    native = src.readings(spark, folder).filter(F.col("channel") == "native")
    mask = F.bit_or(op.label_mask(F.col("text")))
    return native.groupBy("case_id", "page").agg(F.bit_count(mask).cast("long").alias("labels"))


_TURNED = (
    "select case_id, page, cast(case when page % 3 = 0 then 0 when reading_no = 0 then 90 else 270 end as int) as angle, text from readings"
)


@catalog.add(
    "orient_pages",
    f"{READINGS}, turned as ({_TURNED}), s as (select case_id, page, "
    + ", ".join(
        "(" + " + ".join(
            f"coalesce(max(case when angle = {a} then contains({q.anchor('text')}, '{w}')::int end), 0)"
            for w in fixed.ORIENTATION_LABELS
        ) + f") as s{a}"
        for a in (0, 90, 270)
    )
    + " from turned group by case_id, page) select case_id, page, cast(s0 as bigint) as native, case when s0 < 2 and greatest(s90, s270) >= 3 "
    "and greatest(s90, s270) - s0 >= 2 and s90 <> s270 then case when s90 > s270 then 90 else 270 end else 0 end as rotation from s",
)
def orient_pages(spark, folder):
    angle = F.when(F.col("page") % 3 == 0, 0).when(F.col("reading_no") == 0, 90).otherwise(270)
    turned = src.readings(spark, folder).withColumn("angle", angle)
    return op.orient_pages(turned).select(
        "case_id", "page", F.col("native").cast("long").alias("native"), "rotation"
    )


@catalog.add(
    "clean_biometrics_text",
    f"{READINGS} select case_id, page, reading_no from readings where contains({q.anchor('text')}, 'observed flags none') "
    f"or contains({q.anchor('text')}, 'risk flags none')",
)
def clean_biometrics_text(spark, folder):
    read = src.readings(spark, folder)
    return read.filter(op.clean_biometrics(F.col("text"))).select("case_id", "page", "reading_no")


@catalog.add(
    "adjacent_pairs",
    f"with l as (select doc_id, regexp_extract_all(unnest({q.lines('text')}), '[A-Za-z][A-Za-z''-]*') as w from documents), "
    "p as (select doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as pair from l) "
    "select doc_id, count(*) as pairs, count(distinct pair) as distinct_pairs from p group by doc_id",
)
def adjacent_pairs(spark, folder):
    first, second = op.name_pairs(F.col("text"))
    pairs = src.texts(spark, folder).select(
        "doc_id", F.explode_outer(F.arrays_zip(first.alias("a"), second.alias("b"))).alias("p")
    )
    counted = (
        pairs.filter(F.col("p").isNotNull())
        .groupBy("doc_id", F.concat_ws(" ", "p.a", "p.b").alias("pair"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy("doc_id").agg(
        F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("distinct_pairs")
    )


@catalog.add(
    "dedupe_readings",
    f"{READINGS} select case_id, page, reading_no, channel, md5(text) as text_md5 from readings "
    "qualify row_number() over (partition by case_id, page, text order by (channel <> 'native')::int, reading_no) = 1",
)
def dedupe_readings(spark, folder):
    kept = op.dedupe_readings(src.readings(spark, folder))
    return kept.select("case_id", "page", "reading_no", "channel", F.md5("text").alias("text_md5"))

