"""Source and sink operators whose logic can be checked in place."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia import policy as fixed, schemas
from evidentia.operators import regions
from evidentia.plans import bindings as src
from evidentia.plans.catalog import Catalog
from evidentia.plans.catalog.resolve import candidates
from evidentia.session import shared_path
from evidentia.sources import readers, sinks, vocab

catalog = Catalog()
_RECORD = [n for n in schemas.RECORDS.names]


@catalog.add(
    "jsonl_roundtrip",
    f"with {src.cte('predictions', src.PREDICTIONS)} select {', '.join(_RECORD)} from predictions",
)
def jsonl_roundtrip(spark, folder):
    rows = src.bind(spark, folder, src.PREDICTIONS).select(F.to_json(F.struct(*_RECORD)).alias("line"))
    return rows.select(F.from_json("line", schemas.RECORDS).alias("r")).select("r.*")


@catalog.add(
    "record_files",
    f"with {src.cte('predictions', src.PREDICTIONS)} select {', '.join(_RECORD)} from predictions",
)
def record_files(spark, folder):
    """Records written as JSON lines to the shared folder and read again, keys checked by the plan."""
    path = shared_path(spark, "records")
    sinks.write_records(src.bind(spark, folder, src.PREDICTIONS), path)
    return readers.read_records(spark, path, in_plan=True).select(*_RECORD)


@catalog.add(
    "vocab_distinct",
    f"with {src.cte('truth', src.TRUTH)} "
    + " union all ".join(
        f"select distinct '{f}' as field, {f} as value from truth where {f} <> ''"
        for f in ("species_code", "home_world", "declared_purpose")
    ),
)
def vocab_distinct(spark, folder):
    return vocab.category_vocabulary(
        src.bind(spark, folder, src.TRUTH), ("species_code", "home_world", "declared_purpose")
    )


@catalog.add(
    "token_vocab",
    f"with {src.cte('truth', src.TRUTH)} select distinct token from (select unnest(string_split(applicant_name, ' ')) as token from truth) "
    "where regexp_full_match(token, '[A-Za-z]+')",
)
def token_vocab(spark, folder):
    return vocab.name_tokens(src.bind(spark, folder, src.TRUTH))


@catalog.add(
    "group_map_parse",
    "select event_id, 'k' as name, json_extract_string(props, '$.k') as grp from events",
)
def group_map_parse(spark, folder):
    events = src.table(spark, folder, "events").select("event_id", vocab.parse_map(F.col("props")).alias("m"))
    return events.select("event_id", F.explode("m").alias("name", "grp"))


_CELLS = ("left", "top", "width", "height", "block", "paragraph", "line", "confidence")


@catalog.add(
    "word_tsv_parse",
    f"with {src.cte('words', src.WORDS)} select case_id, \"left\", top, line, text, confidence from words "
    "where text <> '' and confidence >= 0 and width > 0 and height > 0 and \"left\" % 11 <> 3",
)
def word_tsv_parse(spark, folder):
    words = src.bind(spark, folder, src.WORDS)
    shown = [
        F.when((F.col("left") % 11 == 3) & F.lit(c == "left"), "?").otherwise(F.col(c).cast("string")) for c in _CELLS
    ]
    rows = words.select("case_id", F.concat_ws("\t", *shown, "text").alias("row"))
    return regions.parse_word_rows(rows, "row").select("case_id", "left", "top", "line", "text", "confidence")


@catalog.add(
    "page_text_quality",
    f"with {src.cte('words', src.WORDS)}, v as (select * from words where text <> '' and confidence >= 0 and width > 0 and height > 0), "
    "l as (select case_id, page, block, paragraph, line, string_agg(text, ' ' order by \"left\") as t, sum(confidence) as c, count(*) as n from v group by all) "
    "select case_id, page, string_agg(t, chr(10) order by block, paragraph, line) as text, round(sum(c) / sum(n), 3) as quality from l group by all",
)
def page_text_quality(spark, folder):
    return regions.page_text(regions.valid_words(src.bind(spark, folder, src.WORDS)))


@catalog.add(
    "page_diagnostics",
    "with p as (select vec_id, floor(abs(unnest(embedding)::double) * 640.0) as gray from embeddings) "
    "select vec_id, round(stddev_pop(gray), 3) as grayscale_contrast, round(count(*) filter (where gray < 96) / count(*), 5) as dark_pixel_fraction, "
    "round(var_pop(gray % 16), 3) as edge_variance from p group by vec_id",
)
def page_diagnostics(spark, folder):
    gray = F.floor(F.abs(F.col("x").cast("double")) * 640.0)
    pixels = (
        src.table(spark, folder, "embeddings")
        .select("vec_id", F.explode("embedding").alias("x"))
        .select("vec_id", gray.alias("gray"), (gray % 16).alias("edge"))
    )
    return regions.page_diagnostics(pixels, ["vec_id"])


@catalog.add(
    "retry_ladder",
    f"with {src.cte('crops', src.CROPS)}, f as (select case_id, field, min(seq) filter (where ocr_quality >= 88) as first from crops group by all) "
    "select c.case_id, c.field, c.seq from crops c join f using (case_id, field) where f.first is null or c.seq <= f.first",
)
def retry_ladder(spark, folder):
    reads = candidates(spark, folder).withColumn(
        "normalized_value", F.when(F.col("ocr_quality") >= 88, "read").otherwise("")
    )
    kept = regions.first_valid_read(reads, ["case_id", "field"], "seq", "normalized_value")
    return kept.select("case_id", "field", "seq")
