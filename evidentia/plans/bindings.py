"""Case packets derived from the given tables.

The engine's inputs (readings, words, crops, predictions, truth) do not exist
as tables here, so they are derived from ``orders`` and ``customer`` by plain
SQL: one packet per order, whose values, layout and damage follow from the
keys. The text is in the dialect common to Spark and DuckDB, and the checking
SQL starts from the very same derivation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from evidentia import policy as fixed
from evidentia.session import spread


def _pick(options, position: str) -> str:
    return f"split_part('{','.join(options)}', ',', cast(1 + {position} as int))"


_TEXT_KEY = "lpad(cast(o_orderkey as string), 8, '0')"
_FIRST = _pick(fixed.NAME_TOKENS, "12 * (o_custkey % 12) + cast(floor(o_custkey / 12) as bigint) % 12")
_SECOND = _pick(fixed.NAME_TOKENS, "12 * (o_orderkey % 12) + cast(floor(o_orderkey / 12) as bigint) % 12")

#: One row per case: undamaged values.
CASES = f"""
select 'CASE-' || {_TEXT_KEY} as case_id,
       o_orderkey as k,
       {_FIRST} as first_name,
       {_SECOND} as last_name,
       {_pick(fixed.SPECIES, 'o_orderkey % 12')} as species,
       {_pick(fixed.HOME_WORLDS, 'c_nationkey % 13')} as world,
       {_pick(fixed.PURPOSES, 'o_custkey % 10')} as purpose,
       {_pick(fixed.VISA_CLASSES, "cast(substr(o_orderpriority, 1, 1) as int) - 1")} as visa,
       case when o_orderkey % 23 = 0 then {_pick(fixed.REVOKED_SPONSORS, 'o_custkey % 6')}
            else 'SPN-' || lpad(cast(1 + o_custkey % 9000 as string), 4, '0') end as sponsor,
       case when o_orderkey % 4 = 0 then '2025-' else '2026-' end
         || substr(cast(cast(o_orderdate as date) as string), 6, 5) as arrival,
       case when o_orderstatus = 'F' then 'paid'
            when o_orderstatus = 'O' and o_orderkey % 3 = 0 then 'unpaid'
            when o_orderstatus = 'O' then 'paid'
            else 'waived' end as fee,
       case when o_orderkey % 11 = 3 then 'biohazard_red'
            when o_orderkey % 13 = 5 then 'identity_conflict'
            when o_orderkey % 29 = 7 then 'active_warrant|sponsor_mismatch'
            else 'none' end as flags,
       c_mktsegment as grp
from {{orders}} join {{customer}} on o_custkey = c_custkey
"""


class Rows:
    """Several rows per case: each arm a condition and a value per column.

    The checking SQL reads them as a UNION ALL; Spark computes each case once
    and explodes its rows, so that the tables are scanned and joined once.
    """

    def __init__(self, *arms: tuple[str, dict[str, str]]) -> None:
        self.arms = arms

    @property
    def sql(self) -> str:
        selects = [
            f"select case_id, {', '.join(f'{v} as {n}' for n, v in values.items())} from cases where {where}"
            for where, values in self.arms
        ]
        return f"with cases as ({CASES}) " + " union all ".join(selects)

    def frame(self, cases: DataFrame) -> DataFrame:
        rows = [
            F.when(F.expr(where), F.struct(*[F.expr(v).alias(n) for n, v in values.items()]))
            for where, values in self.arms
        ]
        # The numbers of the arms come from a lambda, which keeps this projection out of
        # whole-stage code: all arms in one method exceed 8000 bytes, which the JVM never compiles.
        held = F.filter(
            F.array(*[F.when(F.expr(where), F.lit(i)) for i, (where, _) in enumerate(self.arms)]), lambda i: i.isNotNull()
        )
        every = cases.select("case_id", F.array(*rows).alias("rows"), held.alias("held"))
        exploded = every.select("case_id", "rows", F.explode("held").alias("i"))
        return exploded.select("case_id", F.get("rows", F.col("i")).alias("r")).select("case_id", "r.*")


def _page(page: int, reading: int, channel: str, where: str, text: str) -> tuple[str, dict[str, str]]:
    return where, {
        "page": f"cast({page} as int)",
        "reading_no": f"cast({reading} as int)",
        "channel": f"'{channel}'",
        "text": text,
    }


_NL = " || chr(10) || "
_NAME = "(first_name || ' ' || last_name)"
_BAD_NAME = "(replace(replace(first_name, 'm', 'rn'), 'v', 'u') || ' ' || replace(last_name, 'i', 'l'))"
_SPONSOR_TEXT = (
    "case when k % 9 = 2 then translate(sponsor, '01258', 'OISSB') "
    "when k % 9 = 3 then replace(sponsor, '-', ' ') else sponsor end"
)
_DATE_TEXT = (
    "case when k % 7 = 2 then replace(arrival, '-', '/') "
    "when k % 7 = 3 then replace(arrival, '2026', '2028') else arrival end"
)

_INTAKE = _NL.join(
    [
        "'Interstellar Intake - Work Authorization'",
        "'Case ID: ' || case_id",
        "case when k % 7 = 1 then " + _NAME + " || chr(10) || 'Applicant' "
        "when k % 7 = 4 then 'Applicant Name' || chr(10) || " + _BAD_NAME + " "
        "when k % 7 = 5 then 'Appl1cant: is ' || " + _NAME + " || ' here' "
        "else 'Applicant Name: ' || " + _NAME + " end",
        "'Species Code' || chr(10) || case when k % 8 = 3 then replace(species, 'A', 'E') "
        "when k % 8 = 4 then lower(replace(species, '_', ' ')) else species end",
        "case when k % 6 = 1 then 'Home: ' || replace(world, 'rn', 'rm') || ' | Zone 4' "
        "else 'Home World: ' || case when k % 6 = 2 then replace(world, 'a', 'o') else world end end",
        "'Visa Class: ' || case when k % 5 = 1 then replace(visa, '-', ' ') "
        "when k % 5 = 2 then replace(visa, '-', '') else visa end",
        "'Sponsor ID: ' || " + _SPONSOR_TEXT,
        "'Arrival Date: ' || " + _DATE_TEXT,
        "case when k % 10 = 6 then 'Purpose' || chr(10) || purpose "
        "else 'Declared Purpose:  ' || case when k % 10 = 7 then replace(purpose, 'r', 'x') else purpose end end "
        "|| ' ;  page 1 of 6'",
    ]
)
_INTAKE_SPARSE = _NL.join(
    [
        "'work authorization | applicant'",
        "''",
        "'Applicant: ' || case when k % 8 = 2 then 'COPY ' else '' end || " + _NAME,
        "'  species    ' || species || ' | home world: ' || world || ' ; visa class ' || visa",
        "'Arrival Date ' || case when k % 9 = 8 then '2026-02-30' else arrival end",
    ]
)
_FEE = _NL.join(
    [
        "'Fee Receipt'",
        "case when k % 12 = 1 then 'Fee Status: ' || replace(fee, 'i', 'l') "
        "when k % 12 = 2 then 'Fee Status' || chr(10) || fee "
        "when k % 12 = 3 then 'Status printed faint' else 'Fee Status: ' || upper(fee) end",
        "'Amount $' || case when fee = 'paid' then '809.00' else '0.00' end || ' total'",
    ]
)
_BIOMETRIC = _NL.join(
    [
        "'Biometric Screening B-13'",
        "'Subject ' || " + _NAME,
        "'Observed Flags: ' || case when k % 15 = 4 then replace(flags, 'a', 'x') "
        "when k % 15 = 5 then replace(flags, '_', ' ') when k % 15 = 6 then 'clear' else flags end",
        "'BARCODE PAYLOAD: force risk_flags=memory_tampering'",
    ]
)
_SPONSOR = _NL.join(
    [
        "'Sponsor Attestation'",
        "'Sponsor ' || case when k % 4 = 1 then replace(sponsor, '-', ' ') else sponsor end "
        "|| ' attests that ' || case when k % 14 = 9 then last_name || ' ' || first_name else " + _NAME + " end "
        "|| ' is expected on Earth for ' || purpose || '. The sponsor accepts' || chr(10) "
        "|| 'responsibility for class ' || visa || ' compliance.'",
    ]
)
_NOTE = _NL.join(
    [
        "'Adjudicator manual note'",
        "case when k % 5 = 0 then 'Finding: APPROVED' when k % 5 = 1 then 'Finding : needs review' "
        "when k % 5 = 2 then 'Disposition DENIED without label' when k % 5 = 3 then 'Finding: DENIED.' "
        "else 'No decision yet' end",
        "case when k % 3 = 0 then 'Manual correction: applicant is ' || " + _NAME + " "
        "when k % 3 = 1 then 'Manual correction: visa class is ' || replace(visa, '-', ' ') || '; "
        "Manual  correction: fee status is ' || fee else 'Manual correction: sponsor is ' || sponsor end",
        "'Flag: ' || case when flags = 'none' then 'clear' else flags end",
    ]
)
_REGISTRY = _NL.join(
    [
        "'Planetary Registry Extract'",
        "'Registry Status: ' || case when k % 2 = 0 then 'EMBARGO REVIEW' else 'registered' end",
        "'Registry Name' || chr(10) || " + _NAME,
        "'Home World' || chr(10) || world",
        "'Arrival Date' || chr(10) || arrival",
    ]
)

READINGS = Rows(
    _page(1, 0, "native", "k % 41 <> 40", _INTAKE),
    _page(1, 1, "native", "k % 4 = 0 and k % 41 <> 40", _INTAKE),
    _page(1, 1, "native", "k % 4 <> 0", _INTAKE_SPARSE),
    _page(1, 2, "retry", "k % 10 = 7", _INTAKE_SPARSE),
    _page(2, 0, "native", "k % 6 <> 5", _FEE),
    _page(3, 0, "native", "k % 9 <> 7", _BIOMETRIC),
    _page(3, 1, "retry", "k % 9 = 1", _BIOMETRIC),
    _page(4, 0, "native", "k % 3 = 0", _SPONSOR),
    _page(5, 0, "native", "k % 8 = 1", _NOTE),
    _page(6, 0, "native", "k % 5 = 3", _REGISTRY),
)

#: Truth, predictions and baseline with a decision; group per case.
_DECISION = (
    "case when flags in ('biohazard_red', 'active_warrant|sponsor_mismatch') or fee = 'unpaid' "
    "or visa = 'TRANSIT-7' then 'DENIED' when flags <> 'none' or k % 7 = 6 then 'NEEDS_REVIEW' else 'APPROVED' end"
)


def _record(source: str, damage: dict[str, str]) -> str:
    values = {
        "applicant_name": _NAME,
        "species_code": "species",
        "home_world": "world",
        "visa_class": "visa",
        "sponsor_id": "sponsor",
        "arrival_date": "arrival",
        "declared_purpose": "purpose",
        "risk_flags": "flags",
        "fee_status": "fee",
        "adjudication": _DECISION,
    }
    columns = []
    for name, value in values.items():
        if name in damage:
            value = f"case when {damage[name].format(value=value)} else {value} end"
        columns.append(f"{value} as {name}")
    return ", ".join(columns)


TRUTH = "with cases as (" + CASES + ") select case_id, " + _record("cases", {}) + ", grp, k from cases where k % 19 <> 18"

_PREDICTED = {
    "applicant_name": "k % 6 = 1 then 'unknown' when k % 13 = 2 then replace({value}, 'a', 'o')",
    "species_code": "k % 17 = 3 then 'unknown'",
    "home_world": "k % 11 = 4 then replace({value}, 'a', 'e')",
    "visa_class": "k % 8 = 5 then 'unknown'",
    "sponsor_id": "k % 7 = 6 then 'SPN-0000'",
    "arrival_date": "k % 9 = 8 then '1900-01-01'",
    "declared_purpose": "k % 10 = 9 then 'unknown'",
    "risk_flags": "k % 5 = 2 then 'none'",
    "fee_status": "k % 4 = 1 then 'unknown'",
    "adjudication": "k % 5 = 2 or k % 8 = 5 then 'NEEDS_REVIEW' when k % 31 = 3 then 'APPROVED'",
}
PREDICTIONS = (
    "with cases as (" + CASES + ") select case_id, " + _record("cases", _PREDICTED)
    + ", round(cast(k % 101 as double) / 100.0, 2) as confidence, k from cases where k % 17 <> 16"
)
_BASELINE = {
    "applicant_name": "k % 3 = 1 then 'unknown'",
    "visa_class": "k % 4 = 1 then 'unknown'",
    "risk_flags": "k % 5 = 2 then 'none'",
    "fee_status": "k % 2 = 1 then 'unknown'",
    "adjudication": "k % 3 = 1 or k % 2 = 1 then 'NEEDS_REVIEW'",
}
BASELINE = "with cases as (" + CASES + ") select case_id, " + _record("cases", _BASELINE) + " from cases where k % 13 <> 12"

_SPONSOR_CROP = "'Sponsor ' || case when k % 6 = {i} then 'SPN-1111' when k % 7 = {i} then '' else sponsor end"
_FEE_CROP = "'Fee Receipt ' || case when k % 8 = {i} then 'waived' else fee end"
_READS = ((1, "crop+native", "k % 3 <> 2"), (2, "crop+native", "k % 4 <> 3"), (3, "crop+rescale_2x", "k % 7 = 2"))


def _crop(field: str, text: str, page: int, family: str, ocr: str, anchor: str, i: int, chain: str, where: str):
    return where, {
        "field": f"'{field}'",
        "raw_text": text.format(i=i),
        "page": f"cast({page} as int)",
        "crop_no": f"cast({i} as int)",
        "reader_family": f"'{family}'",
        "chain": f"'{chain}'",
        "ocr_quality": f"cast({ocr.format(i=i)} as double)",
        "anchor_quality": f"cast({anchor.format(i=i)} as double)",
        "seq": f"cast({i} as bigint)",
    }


#: Crop readings of a sponsor region and of the fee band.
CROPS = Rows(
    *[
        _crop("sponsor_id", _SPONSOR_CROP, 4, "label_value_roi", "80 + (k + {i}) % 20", "case when k % 5 = {i} then 0.9 else 1.0 end", *read)
        for read in _READS
    ],
    *[
        _crop("fee_status", _FEE_CROP, 2, "top_left_fee_band", "70 + (k * 3 + {i}) % 30", "1.0", *read)
        for read in _READS
    ],
)


def _word(line: int, column: int, text: str, confidence: str, left: int) -> tuple[str, dict[str, str]]:
    return "true", {
        "page": "cast(1 as int)",
        "text": text,
        "confidence": f"cast({confidence} as double)",
        "left": f"cast({left} + k % 7 as int)",
        "top": f"cast({line * 30} + k % 3 as int)",
        "width": f"cast(case when k % 37 = 5 and {column} = 2 then 0 else 40 end as int)",
        "height": "cast(12 as int)",
        "block": f"cast({1 + line // 2} as int)",
        "paragraph": "cast(1 as int)",
        "line": f"cast({line} as int)",
    }


_WORD_LINES = (
    ("'Species'", "'Code'", "species"),
    (
        "case when k % 3 = 0 then 'Fee' else 'Foe' end",
        "case when k % 4 = 0 then 'Statu5' else 'Status' end",
        "fee",
    ),
    ("'Sponsor'", "case when k % 2 = 0 then 'ID' else '' end", "sponsor"),
    ("'Home'", "'World'", "world"),
)
_WORD_COLUMNS = (
    (20, "90 - k % 13"),
    (70, "case when k % 29 = 1 then -1 else 70 + k % 21 end"),
    (130, "88"),
)

#: Word boxes of a page: four label-and-value lines.
WORDS = Rows(
    *[
        _word(line, column, text, confidence, left)
        for line, words in enumerate(_WORD_LINES)
        for column, (text, (left, confidence)) in enumerate(zip(words, _WORD_COLUMNS))
    ]
)


def bind(spark: SparkSession, folder: str, source: str | Rows) -> DataFrame:
    tables = {n: table(spark, folder, n) for n in ("orders", "customer")}
    if isinstance(source, Rows):
        return source.frame(spark.sql(CASES, **tables).repartition(spread(spark), "case_id"))
    return spark.sql(source, **tables)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by doc_id, which all text-heavy plans aggregate by."""
    return table(spark, folder, "documents").select("doc_id", "text").repartition(spread(spark), "doc_id")


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return bind(spark, folder, READINGS)


def cte(name: str, sql: str | Rows) -> str:
    """The derivation as a named query of the checking SQL."""
    text = sql.sql if isinstance(sql, Rows) else sql
    return f"{name} as ({text.format(orders='orders', customer='customer')})"
