"""Evidence resolution, ledgers and conflict-preserving merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia import policy as fixed
from evidentia.functions import fields as fn, text as tx
from evidentia.operators import extract as op, merge, resolve
from evidentia.plans import bindings as src, sqltext as q
from evidentia.plans.catalog import Catalog
from evidentia.policy import DEFAULT

catalog = Catalog()
READINGS = f"with {src.cte('readings', src.READINGS)}"
_SPECIES = ", ".join(f"'{s}'" for s in fixed.SPECIES)
_SENTINEL = "case field " + " ".join(f"when '{f}' then '{v}'" for f, v in fixed.SENTINELS.items()) + " end"

_RESOLVED = f"""
{READINGS}, {q.evidence()},
grouped as (select case_id, channel, field, value, count(distinct source) as sources, count(*) as reads,
  max(weight) as weight from evidence group by all),
ranked as (select *, row_number() over w as r, lead(sources) over w as next_sources, lead(reads) over w as next_reads
  from grouped window w as (partition by case_id, channel, field order by sources desc, reads desc, weight desc, value desc)),
agreed as (select case_id, channel, field, value from ranked where r = 1
  and field in ('applicant_name', 'species_code', 'sponsor_id') and (sources >= 2 or reads >= 3)
  and not coalesce(next_sources = sources and next_reads = reads, false)
  and (field <> 'species_code' or value in ({_SPECIES}))),
preferred as (select * from evidence qualify row_number() over (partition by case_id, channel, field
  order by weight desc, source desc, page, reading_no, ordinal) = 1),
flags as (select case_id, channel, string_agg(distinct flag, '|' order by flag) as value from (
  select case_id, channel, unnest(string_split(value, '|')) as flag from evidence where field = 'risk_flags' and value <> 'none')
  group by 1, 2)
"""


@catalog.add(
    "choose_fields",
    _RESOLVED
    + "select p.case_id, p.channel, p.field, case when p.field = 'risk_flags' then coalesce(f.value, p.value) "
    "else coalesce(a.value, p.value) end as value from preferred p "
    "left join agreed a using (case_id, channel, field) left join flags f using (case_id, channel) "
    "where p.field <> 'registry_embargo_review'",
)
def choose_fields(spark, folder):
    """Consensus, precedence and risk union over all typed evidence."""
    return resolve.resolve_evidence(op.evidence(src.readings(spark, folder), fuzzy=False))


@catalog.add(
    "choose_precedence",
    "select user_id, event_type || ':' || props as winner from events qualify row_number() over "
    "(partition by user_id order by round(value), event_type desc, event_id) = 1",
)
def choose_precedence(spark, folder):
    events = src.table(spark, folder, "events").withColumns(
        {"shown": F.concat_ws(":", "event_type", "props"), "weight": -F.expr("floor(value + 0.5)")}
    )
    winner = resolve.precedence_winner("weight", "event_type", ["event_id"], "shown")
    return events.groupBy("user_id").agg(winner.alias("winner"))


@catalog.add(
    "mode_reject_tie",
    "with c as (select user_id, event_type, count(*) as n from events group by 1, 2), "
    "r as (select *, rank() over (partition by user_id order by n desc) as r from c) "
    "select user_id, case when count(*) = 1 then max(event_type) else '' end as usual from r where r = 1 group by user_id",
)
def mode_reject_tie(spark, folder):
    events = src.table(spark, folder, "events")
    return resolve.mode_without_tie(events, ["user_id"], "event_type", "usual")


@catalog.add(
    "sponsor_packet_mode",
    f"{READINGS}, kept as (select case_id, text from readings where channel = 'native' "
    "qualify row_number() over (partition by case_id, page, text order by reading_no) = 1), "
    "s as (select case_id, 'SPN-' || translate(unnest(regexp_extract_all(upper(text), '\\bSPN[- ]?([0-9OILSBZ]{4})\\b', 1)), 'OILSBZ', '011582') as v from kept), "
    "c as (select case_id, v, count(*) as n from s where v <> 'SPN-0000' group by 1, 2), "
    "r as (select *, rank() over (partition by case_id order by n desc) as r from c) "
    "select case_id, case when count(*) = 1 then max(v) else '' end as sponsor from r where r = 1 group by case_id",
)
def sponsor_packet_mode(spark, folder):
    native = op.dedupe_readings(src.readings(spark, folder).filter(F.col("channel") == "native"))
    reads = native.select("case_id", F.explode_outer(fn.repaired_sponsors(F.col("text"))).alias("v"))
    reads = reads.filter(F.col("v") != fixed.SENTINELS["sponsor_id"])
    return resolve.mode_without_tie(reads, ["case_id"], "v", "sponsor")


@catalog.add(
    "singleton_promote",
    "select user_id, cast(cast(ts as date) as varchar) as day, case when count(distinct event_type) = 1 then min(event_type) else '' end as only_type "
    "from events group by all",
)
def singleton_promote(spark, folder):
    events = src.table(spark, folder, "events")
    return events.groupBy("user_id", F.to_date("ts").cast("string").alias("day")).agg(
        F.coalesce(resolve.singleton("event_type"), F.lit("")).alias("only_type")
    )


@catalog.add(
    "finding_resolution",
    f"{READINGS}, r as (select case_id, text, {q.rows('text')} as rws, {q.kind('text')} as kind from readings), "
    f"l as (select *, {q.label('text', 'rws', 'Finding')} as lab from r where kind = 'note' or contains(lower(text), 'finding')), "
    f"f as (select case_id, nullif({q.finding('text', 'Finding\\s*:\\s*')}, '') as manual, "
    f"case when kind = 'note' then {q.finding(chr(34) + 'src' + chr(34))} else '' end as note from (select *, case when lab <> '' then lab else text end as src from l)) "
    "select case_id, case when count(distinct manual) = 1 then max(manual) when count(distinct manual) > 1 then 'NEEDS_REVIEW' "
    "when bool_or(note = 'DENIED') then 'DENIED' when bool_or(note = 'NEEDS_REVIEW') then 'NEEDS_REVIEW' else '' end as finding "
    "from f group by case_id",
)
def finding_resolution(spark, folder):
    text = F.col("text")
    read = src.readings(spark, folder).withColumns({"rows": tx.rows_text(text), "kind": op.page_kind(text)})
    read = read.filter((F.col("kind") == "note") | F.contains(F.lower(text), F.lit("finding")))
    labelled = tx.extract_label(text, F.col("rows"), "Finding")
    rows = read.select(
        "case_id",
        op.manual_finding(text).alias("manual"),
        F.when(F.col("kind") == "note", fn.find_finding(tx.first_nonempty(labelled, text)))
        .otherwise("")
        .alias("note"),
    )
    return resolve.finding_resolution(rows, ["case_id"])


def candidates(spark, folder):
    """Crop readings with their normalised value, as the crop reader emits them."""
    crops = src.bind(spark, folder, src.CROPS)
    value = fn.normalize_candidate(F.col("field"), F.col("raw_text"), fuzzy=False)
    return crops.select(
        "case_id",
        "field",
        "raw_text",
        value.alias("normalized_value"),
        "page",
        F.struct("page", F.col("crop_no").alias("box")).alias("crop"),
        "reader_family",
        F.split("chain", r"\+").alias("transform_chain"),
        "ocr_quality",
        "anchor_quality",
        tx.excerpt(F.col("raw_text")).alias("visible_evidence_excerpt"),
        "seq",
    )


CANDIDATES = (
    f"with {src.cte('crops', src.CROPS)}, candidates as (select *, case field when 'sponsor_id' then {q.sponsor('raw_text')} "
    f"else {q.fee_word('raw_text')} end as value from crops)"
)


@catalog.add(
    "ledger_resolve",
    CANDIDATES
    + ", valid as (select * from candidates where value <> ''), "
    "best as (select case_id, field, value from valid qualify row_number() over (partition by case_id, field order by anchor_quality desc, ocr_quality desc, seq) = 1), "
    "agg as (select case_id, field, count(*) as n, count(distinct value) as vals from valid group by all), "
    "con as (select v.case_id, v.field, string_agg(distinct v.value, '|' order by v.value) as conflicts from valid v join best b using (case_id, field) where v.value <> b.value group by all) "
    "select c.case_id, c.field, c.candidates, coalesce(b.value, '') as selected_value, case when b.value is null then 'no_valid_candidate' "
    "when a.n > 1 and a.vals = 1 then 'corroborated_equivalent_readings' else 'highest_anchor_then_ocr_quality' end as resolution_reason, "
    "coalesce(x.conflicts, '') as conflicts from (select case_id, field, count(*) as candidates from candidates group by all) c "
    "left join best b using (case_id, field) left join agg a using (case_id, field) left join con x using (case_id, field)",
)
def ledger_resolve(spark, folder):
    ledger = resolve.resolve_ledger(candidates(spark, folder))
    return ledger.withColumn("conflicts", F.array_join("conflicts", "|"))


@catalog.add(
    "corroborated_distinct",
    CANDIDATES
    + " select case_id, case when count(distinct nullif(value, '')) = 1 and count(distinct case when value <> '' and anchor_quality = 1.0 "
    "and ocr_quality >= 85 and chain = 'crop+native' then crop_no end) >= 2 then max(value) else '' end as sponsor_id "
    "from candidates where field = 'sponsor_id' group by case_id",
)
def corroborated_distinct(spark, folder):
    return resolve.corroborated_sponsor(candidates(spark, folder))


@catalog.add(
    "fee_band_agreed",
    CANDIDATES
    + " select case_id, case when count(distinct value) = 1 then max(value) else '' end as fee_status from candidates "
    "where reader_family = 'top_left_fee_band' and anchor_quality = 1.0 and value <> '' group by case_id",
)
def fee_band_agreed(spark, folder):
    return resolve.agreed_fee_band(candidates(spark, folder))


PAIR = f"with {src.cte('predictions', src.PREDICTIONS)}, {src.cte('baseline', src.BASELINE)}"


@catalog.add(
    "fill_from_retry",
    PAIR + " select b.case_id, " + ", ".join(
        f"case when b.{f} = '{s}' and p.{f} <> '{s}' then p.{f} else b.{f} end as {f}" for f, s in fixed.SENTINELS.items()
    ) + " from baseline b left join predictions p using (case_id)",
)
def fill_from_retry(spark, folder):
    base = src.bind(spark, folder, src.BASELINE)
    again = src.bind(spark, folder, src.PREDICTIONS).select(
        "case_id", *[F.col(f).alias(f"retry_{f}") for f in fixed.FIELDS]
    )
    return base.join(again, "case_id", "left").select(
        "case_id", *[merge.fill_sentinel(f, F.col(f), F.col(f"retry_{f}")).alias(f) for f in fixed.FIELDS]
    )


@catalog.add(
    "risk_union",
    PAIR + ", f as (select case_id, unnest(string_split(risk_flags, '|')) as flag from predictions union all "
    "select case_id, unnest(string_split(case when cast(right(case_id, 2) as int) % 5 = 0 then 'rescinded_denial' else risk_flags end, '|')) from baseline "
    "where case_id in (select case_id from predictions)) "
    "select case_id, coalesce(string_agg(distinct flag, '|' order by flag) filter (where flag <> 'none'), 'none') as risk_flags from f group by case_id",
)
def risk_union(spark, folder):
    own = src.bind(spark, folder, src.PREDICTIONS).select("case_id", "risk_flags")
    other = src.bind(spark, folder, src.BASELINE).select(
        "case_id",
        F.when(F.right("case_id", F.lit(2)).cast("int") % 5 == 0, "rescinded_denial")
        .otherwise(F.col("risk_flags"))
        .alias("more"),
    )
    joined = own.join(other, "case_id", "left")
    return joined.select(
        "case_id",
        merge.add_flags(F.col("risk_flags"), F.coalesce("more", F.lit("none"))).alias("risk_flags"),
    )


_OVERRIDE = [
    f"case when count(distinct nullif({_v}, '')) = 1 then max({_v}) else '' end as {n}"
    for n, _v in (("sponsor_id", "fix_sponsor"), ("fee_status", "fix_fee"))
]


@catalog.add(
    "correction_override",
    f"{READINGS}, {src.cte('predictions', src.PREDICTIONS)}, x as (select case_id, "
    + q.sponsor("regexp_extract(text, '(?i)\\bManual\\s+correction\\s*:\\s*sponsor\\s+is\\s+(SPN[- ]?[0-9]{4})\\b', 1)")
    + " as fix_sponsor, lower(regexp_extract(text, '(?i)\\bManual\\s+correction\\s*:\\s*fee\\s+status\\s+is\\s+(paid|unpaid|waived)\\b', 1)) as fix_fee "
    f"from readings where channel = 'native'), o as (select case_id, {', '.join(_OVERRIDE)} from x group by case_id) "
    "select p.case_id, coalesce(nullif(o.sponsor_id, ''), p.sponsor_id) as sponsor_id, coalesce(nullif(o.fee_status, ''), p.fee_status) as fee_status "
    "from predictions p left join o using (case_id)",
)
def correction_override(spark, folder):
    native = src.readings(spark, folder).filter(F.col("channel") == "native")
    stated = op.manual_corrections(F.col("text"))
    read = native.select(
        "case_id", *[F.nullif(stated[n], F.lit("")).alias(n) for n in ("sponsor_id", "fee_status")]
    )
    fixes = read.groupBy("case_id").agg(
        *[resolve.singleton(n).alias(f"fix_{n}") for n in ("sponsor_id", "fee_status")]
    )
    rows = src.bind(spark, folder, src.PREDICTIONS).join(fixes, "case_id", "left")
    return rows.select(
        "case_id", *[merge.override(F.col(n), F.col(f"fix_{n}")).alias(n) for n in ("sponsor_id", "fee_status")]
    )


@catalog.add(
    "differential_merge",
    PAIR + ", rerun as (select * from predictions where adjudication = 'NEEDS_REVIEW') "
    "select case_id, adjudication, fee_status from baseline where case_id not in (select case_id from rerun) "
    "union all select case_id, adjudication, fee_status from rerun",
)
def differential_merge(spark, folder):
    full = src.bind(spark, folder, src.BASELINE).select("case_id", "adjudication", "fee_status")
    rerun = src.bind(spark, folder, src.PREDICTIONS).filter(F.col("adjudication") == "NEEDS_REVIEW")
    return merge.merge_rerun(full, rerun)


@catalog.add(
    "apply_selections",
    PAIR + " select p.case_id, "
    + ", ".join(
        f"case when nullif(b.{f}, 'unknown') is not null and b.{f} <> p.{f} then b.{f} else p.{f} end as {f}, "
        f"coalesce(nullif(b.{f}, 'unknown') is not null and b.{f} <> p.{f}, false) as changed_{f}"
        for f in ("applicant_name", "sponsor_id")
    )
    + " from predictions p left join baseline b using (case_id)",
)
def apply_selections(spark, folder):
    fields = ("applicant_name", "sponsor_id")
    chosen = src.bind(spark, folder, src.BASELINE).select(
        "case_id", *[F.nullif(F.col(f), F.lit("unknown")).alias(f) for f in fields]
    )
    rows = src.bind(spark, folder, src.PREDICTIONS).select("case_id", *fields)
    return merge.apply_selections(rows, chosen, fields)


@catalog.add(
    "category_promotion",
    f"{READINGS}, {src.cte('predictions', src.PREDICTIONS)}, "
    + "hits as (" + " union all ".join(
        f"select case_id, channel, '{op._anchor(w)}' as key, '{w}' as value from readings where contains(' ' || {q.anchor('text')} || ' ', ' {op._anchor(w)} ')"
        for w in fixed.HOME_WORLDS
    ) + "), h as (select case_id, case when count(distinct value) filter (where channel = 'native') = 1 then max(value) filter (where channel = 'native') end as exact, "
    "case when count(distinct value) filter (where channel = 'retry') = 1 then max(value) filter (where channel = 'retry') end as again from hits group by case_id), "
    "s as (select p.case_id, coalesce(h.exact, p.home_world) as v, h.again from predictions p left join h using (case_id)) "
    "select case_id, case when again is not null and (v = 'unknown' or v not in (" + ", ".join(f"'{w}'" for w in fixed.HOME_WORLDS) + ")) then again else v end as home_world from s",
)
def category_promotion(spark, folder):
    read = src.readings(spark, folder).select(
        "case_id", "channel", F.explode_outer(op.category_hits(F.col("text"), F.lit("other"))["home_world"]).alias("v")
    )
    hit = {c: F.when(F.col("channel") == c, F.col("v")) for c in ("native", "retry")}
    hits = read.groupBy("case_id").agg(
        resolve.singleton(hit["native"]).alias("exact"),
        F.max(hit["native"]).isNotNull().alias("any_exact"),
        resolve.singleton(hit["retry"]).alias("again"),
    )
    rows = src.bind(spark, folder, src.PREDICTIONS).join(hits, "case_id", "left")
    promoted = merge.promote_category(
        "home_world",
        F.col("home_world"),
        F.col("exact"),
        F.coalesce("any_exact", F.lit(False)),
        F.lit(None).cast("string"),
        F.col("again"),
    )
    return rows.select("case_id", promoted.alias("home_world"))
