"""Secret scans with an incremental blob ledger.

Every version of every file is addressed by the SHA-256 of its content (a
blob). The ledger has one row per scanned pair of blob and rule version, with
the spans found. A scan looks only at pairs that the ledger lacks, so a new
rule version rescans every blob for that rule alone and a new commit rescans
only changed content; findings reach all paths by a join on the blob.

Only column expressions. Matches are located without a position function:
splitting a text by the pattern gives the gaps between its matches, and a
running sum over gaps and matches gives code-point offsets. Only texts with a
match are exploded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from evidentia.llm.common import columns, stored


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if ``required`` matches them as a whole."""

    kind: str
    version: int
    pattern: str
    required: str

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base rules, in the order in which spans are listed.
_HEAD = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
RULES = (
    Rule("assign", 1, _HEAD + "[A-Za-z0-9+/_.=-]+", _HEAD + "[A-Za-z0-9+/_.=-]{6,}"),
    Rule("access", 1, "AKIA[A-Z0-9]+", ".{20,}"),
    Rule("hex", 1, "[0-9a-f]{24,}", ".{24,}"),
)
LEDGER = "blob string, rule string, spans array<struct<start: int, end: int>>"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _pieces(rule: Rule, order: int, text: Column, wanted: Column) -> Column:
    """Array of (rule, order, ordinal, gap, size, valid), one for each match of the pattern."""
    found = F.when(wanted, F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    gaps = F.when(F.size(found) > 0, F.split(text, rule.pattern, -1)).otherwise(F.array().cast("array<string>"))
    return F.zip_with(
        F.slice(gaps, 1, F.greatest(F.size(found), F.lit(0))),
        F.transform(found, lambda m, i: F.struct(m.alias("m"), i.alias("i"))),
        lambda gap, match: F.struct(
            F.lit(rule.key).alias("rule"),
            match["i"].alias("ordinal"),
            F.length(gap).alias("gap"),
            F.length(match["m"]).alias("size"),
            match["m"].rlike(f"^(?:{rule.required})$").alias("valid"),
        ),
    )


def scan(pairs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows of (blob, text, missing array<rule key>): one for each missing pair, also without a span."""
    found = pairs.select(
        "blob",
        F.concat(*[_pieces(r, i, F.col("text"), F.array_contains("missing", r.key)) for i, r in enumerate(rules)]).alias("p"),
        "missing",
    )
    found = stored(found)
    rows = found.where(F.size("p") > 0).select("blob", F.explode("p").alias("p")).select("blob", "p.*")
    place = Window.partitionBy("blob", "rule").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(place).cast("int"))
    rows = rows.where("valid").withColumn("start", (F.col("end") - F.col("size")).cast("int"))
    spans = rows.groupBy("blob", "rule").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    asked = found.select("blob", F.explode("missing").alias("rule"))
    none = F.array().cast("array<struct<start: int, end: int>>")
    return asked.join(spans, ["blob", "rule"], "left").withColumn("spans", F.coalesce("spans", none))


def update_ledger(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    path: str = "path",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(new ledger, paths with blobs) after scanning what ``ledger`` lacks.

    ``versions`` holds one row for each version of each path. Null text is the
    empty blob; null paths and repeated rows are kept. Copies are scanned once:
    a blob is read from the row with the smallest path.
    """
    addressed = versions.withColumn("blob", blob_id(F.col(text)))
    paths = stored(addressed.drop(text))
    keys = F.array(*[F.lit(r.key) for r in rules])
    blobs = paths.groupBy("blob").agg(F.min(path).alias("reader"))
    if ledger is None:
        unseen = blobs.withColumn("missing", keys)
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        unseen = blobs.join(seen, "blob", "left").withColumn(
            "missing", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))
        )
        unseen = unseen.where(F.size("missing") > 0).drop("seen")
    unseen = unseen.withColumnRenamed("blob", "wanted")
    texts = addressed.select(F.col(path).alias("reader"), "blob", F.coalesce(F.col(text), F.lit("")).alias("text"))
    # a path may have several versions and be null; equal rows of one path are read once
    pairs = texts.join(unseen, texts["reader"].eqNullSafe(unseen["reader"]) & (texts["blob"] == unseen["wanted"]))
    pairs = pairs.select("blob", "text", "missing")
    found = scan(pairs, rules).dropDuplicates(["blob", "rule"])
    if ledger is not None:
        found = ledger.select("blob", "rule", "spans").unionByName(found)
    return stored(found), paths


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``paths`` with ``spans``: array of (start, kind_order, kind, end) over the current rules, sorted.

    Blobs without a span are not in the joined side; such paths get an empty array.
    """
    current = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    hits = ledger.where(F.size("spans") > 0).withColumn("o", current[F.col("rule")]).where("o is not null")
    hits = hits.select("blob", "o", F.explode("spans").alias("s"))
    span = F.struct("s.start", F.col("o").alias("kind_order"), F.get(kinds, F.col("o")).alias("kind"), "s.end")
    hits = hits.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    joined = paths.drop("spans").join(hits, "blob", "left")
    none = F.array().cast("array<struct<start: int, kind_order: int, kind: string, end: int>>")
    return joined.withColumn("spans", F.coalesce("spans", none))


def redact(docs: DataFrame, found: DataFrame, mask: str = "[SECRET]", text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with every run of overlapping spans replaced by ``mask``; other texts unchanged.

    ``found`` is (key, blob, spans) of :func:`findings`. Rows join by key and
    blob, so versions of one path keep their own spans.
    """
    hits = found.where(F.size("spans") > 0).select(F.col(key).alias("__key"), F.col("blob").alias("__blob"), "spans").dropDuplicates(["__blob"])
    hits = hits.select("__blob", F.posexplode("spans").alias("i", "s"))
    before = Window.partitionBy("__blob").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    hits = hits.withColumn("reach", F.coalesce(F.max("s.end").over(before), F.lit(0)))
    # a clean piece ends where a run of overlapping spans starts; the last piece follows the last end
    piece = F.when((F.col("i") == 0) | (F.col("s.start") >= F.col("reach")), F.struct(F.col("reach").alias("a"), F.col("s.start").alias("b")))
    cuts = hits.groupBy("__blob").agg(
        F.array_sort(F.collect_list(piece)).alias("__pieces"), F.max("s.end").alias("__rest")
    )
    rows = docs.withColumn("__id", blob_id(F.col(text)))
    rows = rows.join(cuts, rows["__id"] == cuts["__blob"], "left")
    clean = F.transform("__pieces", lambda p: F.substring(F.col(text), p["a"] + 1, p["b"] - p["a"]))
    rest = F.substring(F.col(text), F.col("__rest") + 1, F.length(F.col(text)))
    new = F.when(F.col("__rest").isNull(), F.col(text)).otherwise(F.array_join(F.concat(clean, F.array(rest)), mask))
    return rows.withColumn(text, new).select(*columns(docs))


def span_text(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per path: counts by kind, the hash of the span list and the list."""
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    text = span_text(F.col("spans"))
    return found.select(
        key,
        *[count(r.kind) for r in RULES],
        F.sha2(text.cast("binary"), 256).alias("base_sha256"),
        text.alias("spans"),
    )


_SQL_HEAD = "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\\x20*[:=]\\x20*[\"'']?"
_SQL_KINDS = ((0, "assign", _SQL_HEAD + "[A-Za-z0-9+/_.=-]+", _SQL_HEAD + "[A-Za-z0-9+/_.=-]{6,}"), (1, "access", "AKIA[A-Z0-9]+", ".{20,}"), (2, "hex", "[0-9a-f]+", ".{24,}"))
#: The same in DuckDB.
SQL = (
    "with t as (select doc_id, coalesce(text, '') as text from documents), p as ("
    + " union all ".join(
        f"select doc_id, {i} as o, '{k}' as kind, '{need}' as need, regexp_extract_all(text, '{pat}') as m, "
        f"[length(x) for x in string_split_regex(text, '{pat}')] as g from t where regexp_matches(text, '{pat}')"
        for i, k, pat, need in _SQL_KINDS
    )
    + "), e as (select doc_id, o, kind, need, unnest(m) as m, unnest(g[:len(m)]) as g, unnest(range(len(m))) as i from p), "
    "c as (select *, (sum(g + length(m)) over (partition by doc_id, o order by i))::bigint as e from e), "
    "s as (select doc_id, o, kind, e - length(m) as s, e from c where regexp_full_match(m, need)), "
    "a as (select doc_id, count(*) filter (where o = 0) as n_assign, count(*) filter (where o = 1) as n_access, "
    "count(*) filter (where o = 2) as n_hex, string_agg(kind || ':' || s || ':' || e, ',' order by s, o) as spans from s group by doc_id) "
    "select t.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, "
    "sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans from t left join a using (doc_id)"
)
