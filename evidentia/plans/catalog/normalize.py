"""Normalisers and validators, over whole documents and derived readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia import policy as fixed
from evidentia.functions import fields as fn, text as tx
from evidentia.plans import bindings as src, sqltext as q
from evidentia.plans.catalog import Catalog

catalog = Catalog()
READINGS = f"with {src.cte('readings', src.READINGS)} "


@catalog.add(
    "norm_space_anchor",
    f"select doc_id, md5({q.norm('text')}) as norm_md5, cast(length({q.norm('text')}) as bigint) as norm_chars, "
    f"md5({q.anchor('text')}) as anchor_md5 from documents",
)
def norm_space_anchor(spark, folder):
    text = F.col("text")
    return src.texts(spark, folder).select(
        "doc_id",
        F.md5(tx.normalize_space(text)).alias("norm_md5"),
        F.length(tx.normalize_space(text)).cast("long").alias("norm_chars"),
        F.md5(tx.anchor_text(text)).alias("anchor_md5"),
    )


@catalog.add(
    "category_key",
    f"select doc_id, md5(regexp_replace({q.fold('text')}, '[^a-z0-9]', '', 'g')) as key_md5 from documents",
)
def category_key(spark, folder):
    return src.texts(spark, folder).select(
        "doc_id", F.md5(tx.category_key(F.col("text"))).alias("key_md5")
    )


@catalog.add("sanitize_mask_digits", f"select doc_id, md5({q.mask('text')}) as masked_md5 from documents")
def sanitize_mask_digits(spark, folder):
    return src.texts(spark, folder).select(
        "doc_id", F.md5(tx.mask_digits(F.col("text"))).alias("masked_md5")
    )


@catalog.add(
    "row_texts",
    f"select conv_id, turn, md5(array_to_string({q.rows('text')}, chr(10))) as rows_md5, "
    f"substr({q.norm('text')}, 1, 160) as excerpt from conversations",
)
def row_texts(spark, folder):
    text = F.col("text")
    return src.table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        F.md5(tx.rows_text(text)).alias("rows_md5"),
        tx.excerpt(text).alias("excerpt"),
    )


def _lines(spark, folder):
    documents = src.texts(spark, folder)
    return documents.select(F.explode_outer(tx.raw_lines(F.col("text"))).alias("line"))


_LINES = f"with l as (select unnest({q.lines('text')}) as line from documents) "


@catalog.add(
    "clean_name",
    _LINES + f"select {q.name('line')} as name, count(*) as lines from l group by 1",
)
def clean_name(spark, folder):
    return (
        _lines(spark, folder)
        .groupBy(fn.clean_name(F.col("line")).alias("name"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )


@catalog.add(
    "clean_species",
    _LINES + f"select {q.species('line')} as code, count(*) as lines from l group by 1",
)
def clean_species(spark, folder):
    return (
        _lines(spark, folder)
        .groupBy(fn.clean_species(F.col("line")).alias("code"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )


@catalog.add(
    "clean_date_valid",
    READINGS + f"select {q.day('text')} as arrival, count(*) as readings from readings group by 1",
)
def clean_date_valid(spark, folder):
    return (
        src.readings(spark, folder)
        .groupBy(fn.clean_date(F.col("text")).alias("arrival"))
        .agg(F.count(F.lit(1)).alias("readings"))
    )


@catalog.add(
    "clean_sponsor",
    READINGS + f"select {q.sponsor('text')} as sponsor, count(*) as readings from readings group by 1",
)
def clean_sponsor(spark, folder):
    return (
        src.readings(spark, folder)
        .groupBy(fn.clean_sponsor(F.col("text")).alias("sponsor"))
        .agg(F.count(F.lit(1)).alias("readings"))
    )


@catalog.add(
    "sponsor_glyph_repair",
    READINGS
    + "select 'SPN-' || translate(raw, 'OILSBZ', '011582') as sponsor, count(*) as reads from ("
    "select unnest(regexp_extract_all(upper(text), '\\bSPN[- ]?([0-9OILSBZ]{4})\\b', 1)) as raw from readings) "
    "group by 1",
)
def sponsor_glyph_repair(spark, folder):
    return (
        src.readings(spark, folder)
        .select(F.explode_outer(fn.repaired_sponsors(F.col("text"))).alias("sponsor"))
        .filter(F.col("sponsor").isNotNull())
        .groupBy("sponsor")
        .agg(F.count(F.lit(1)).alias("reads"))
    )


@catalog.add(
    "flags_exact",
    READINGS + f"select {q.flags('text')} as flags, count(*) as readings from readings group by 1",
)
def flags_exact(spark, folder):
    return (
        src.readings(spark, folder)
        .groupBy(fn.exact_flags(F.col("text")).alias("flags"))
        .agg(F.count(F.lit(1)).alias("readings"))
    )


@catalog.add(
    "fee_anchor_exact",
    READINGS
    + f"select case_id, page, reading_no, channel, {q.anchored_fee('text')} as fee from readings",
)
def fee_anchor_exact(spark, folder):
    return src.readings(spark, folder).select(
        "case_id", "page", "reading_no", "channel", fn.anchored_fee(F.col("text"), fuzzy=False).alias("fee")
    )


@catalog.add(
    "visa_regex_hyphen",
    READINGS
    + f"select visa, case when visa in ('XW1', 'XW2', 'DIP1', 'MED3', 'TRANSIT7') then "
    f"left(visa, length(visa) - 1) || '-' || right(visa, 1) else visa end as printed, count(*) as readings "
    f"from (select {q.visa('text')} as visa from readings) group by 1, 2",
)
def visa_regex_hyphen(spark, folder):
    found = src.readings(spark, folder).select(fn.find_visa(F.col("text")).alias("visa"))
    return found.groupBy("visa", fn.output_visa(F.col("visa")).alias("printed")).agg(
        F.count(F.lit(1)).alias("readings")
    )


@catalog.add(
    "candidate_normalized",
    f"with {src.cte('crops', src.CROPS)} select field, case field when 'sponsor_id' then {q.sponsor('raw_text')} "
    f"else {q.fee_word('raw_text')} end as normalized_value, count(*) as crops from crops group by 1, 2",
)
def candidate_normalized(spark, folder):
    crops = src.bind(spark, folder, src.CROPS)
    value = fn.normalize_candidate(F.col("field"), F.col("raw_text"), fuzzy=False)
    return crops.groupBy("field", value.alias("normalized_value")).agg(F.count(F.lit(1)).alias("crops"))


@catalog.add(
    "flag_sets",
    f"with {src.cte('truth', src.TRUTH)} select flag, count(*) as cases from ("
    "select unnest(case when risk_flags = 'none' then ['(empty)'] else string_split(risk_flags, '|') end) as flag from truth) "
    "group by 1",
)
def flag_sets(spark, folder):
    flags = fn.flag_array(F.col("risk_flags"))
    shown = F.when(F.size(flags) == 0, F.array(F.lit("(empty)"))).otherwise(flags)
    return (
        src.bind(spark, folder, src.TRUTH)
        .select(F.explode(shown).alias("flag"))
        .groupBy("flag")
        .agg(F.count(F.lit(1)).alias("cases"))
    )


@catalog.add(
    "enum_exact",
    READINGS
    + "select fee, count(*) as pages from (select case "
    + " ".join(
        f"when replace({q.fold(q.norm('raw'))}, '_', ' ') = '{c}' then '{c}'" for c in fixed.FEE_STATES
    )
    + " else '' end as fee from (select regexp_extract(text, '(?i)fee status[: ]*\\n?([^\\n]*)', 1) as raw "
    "from readings where page = 2)) group by 1",
)
def enum_exact(spark, folder):
    raw = F.regexp_extract("text", r"(?i)fee status[: ]*\n?([^\n]*)", 1)
    pages = src.readings(spark, folder).filter(F.col("page") == 2)
    return pages.groupBy(fn.exact_enum(raw, fixed.FEE_STATES).alias("fee")).agg(
        F.count(F.lit(1)).alias("pages")
    )
