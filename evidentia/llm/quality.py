"""Quality rules with host-level verdicts.

Each document is measured and tested on its own; the failures are then added
up by host, the failure rate of a host is shrunk towards all hosts by a beta
prior whose parameters are estimated from the hosts themselves, and hosts
whose shrunk rate is too high take their documents with them.

Everything about one text stays in its row (no shuffle of words or windows):
repeated windows are found by sorting the hashed windows of a text, so the work
is n log n in its words. Measures are written once, narrow, without texts; host
sums are pre-aggregated, and the driver sees one row of moments.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from evidentia.llm.common import BLANKS, columns, stored, words


@dataclass(frozen=True)
class Limits:
    """A document fails a rule beyond these values; a host beyond ``host_rate``."""

    words: int = 50
    repeated_percent: int = 50
    symbol_percent: int = 10
    duplicate_line_percent: int = 30
    shortest_mean_word: int = 2
    longest_mean_word: int = 20
    host_rate: float = 0.5


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: Fixed value.
SYMBOLS = "#*$%&|<>"
WINDOW = 3


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the columns of MEASURES (long).

    Null text has no words and no lines; every measure is then 0.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.drop(*MEASURES).withColumn("__w", words(F.col(text)))
    lines = F.filter(F.split(value, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    rows = rows.withColumn("__l", lines)
    rows = rows.withColumn("n_symbols", F.regexp_count(value, F.lit(f"[{SYMBOLS}]"))).drop(text)
    n = F.size("__w")
    window = F.transform(
        F.slice("__w", 1, F.greatest(n - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get("__w", i + k) for k in range(1, WINDOW)]),
    )
    rows = rows.select(
        *columns(rows, "__w", "__l"),
        n.alias("n_words"),
        F.length(F.array_join("__w", "")).alias("word_chars"),
        F.size("__l").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).alias("n_dup_lines"),
        window.alias("__h"),
    )
    unique = F.size(F.array_distinct("__h")) == F.size("__h")
    none = F.array().cast("array<struct<h: bigint, i: int>>")
    rows = rows.withColumn(
        "__s", F.when(unique, none).otherwise(F.array_sort(F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    ).drop("__h")
    again = F.filter(
        "__s",
        lambda x, k: F.coalesce(F.when(k > 0, F.get("__s", k - 1))["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("__s", k + 1)["h"] == x["h"], F.lit(False)),
    )
    rows = rows.withColumn("__p", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("__s")
    steps = F.transform("__p", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("__p", k + 1) - x, F.lit(WINDOW))))
    rows = rows.withColumn("n_repeat_words", F.aggregate(steps, F.lit(0), lambda a, b: a + b)).drop("__p")
    return rows.withColumns({c: F.col(c).cast("long") for c in MEASURES})


def base_failed(limits: Limits = Limits()) -> Column:
    return (F.col("n_words") < limits.words) | (100 * F.col("n_repeat_words") > limits.repeated_percent * F.col("n_words"))


def any_failed(limits: Limits = Limits()) -> Column:
    """The base rules, many symbols, many repeated lines, words too short or too long on average."""
    return (
        base_failed(limits)
        | (100 * F.col("n_symbols") > limits.symbol_percent * F.col("word_chars"))
        | (100 * F.col("n_dup_lines") > limits.duplicate_line_percent * F.col("n_lines"))
        | (F.col("word_chars") < limits.shortest_mean_word * F.col("n_words"))
        | (F.col("word_chars") > limits.longest_mean_word * F.col("n_words"))
    )


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(alpha, beta) from the moments of the hosts' rates; hosts has n and failed.

    The share of the variance between hosts follows from the weighted squared
    deviations of the rates and what binomial noise alone would give. Without
    hosts, or where noise explains all, the prior is as strong as a million
    documents.
    """
    f, n = F.col("failed").cast("double"), F.col("n").cast("double")
    row = hosts.agg(F.count("*").alias("hosts"), F.sum(n).alias("n"), F.sum(f).alias("f"), F.sum(n * n).alias("n2"), F.sum(f * f / n).alias("f2")).first()
    if not row["n"]:
        return 0.5, 0.5
    mean = row["f"] / row["n"]
    noise, room = mean * (1 - mean), row["n"] - row["n2"] / row["n"] - (row["hosts"] - 1)
    share = ((row["f2"] - mean * mean * row["n"]) / noise - (row["hosts"] - 1)) / room if noise > 0 and room > 0 else 0.0
    strength = 1 / min(max(share, 1e-6), 0.999) - 1
    return mean * strength, (1 - mean) * strength


def judge(docs: DataFrame, host: str = "source", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Rows of ``docs`` without the text, with measures, base_failed, failed, host_rate and kept.

    Null hosts are one host. Null and empty texts fail (too few words).
    Repeated rows count each. Empty input gives an empty result. Columns of
    the input that carry a name of the result are replaced.
    """
    added = ("base_failed", "failed", "host_rate", "kept")
    docs = docs.drop(*[c for c in added if c not in (host, text)])
    rows = measures(docs, text).withColumn("base_failed", base_failed(limits)).withColumn("failed", any_failed(limits))
    rows = stored(rows)
    hosts = rows.groupBy(host).agg(F.count("*").alias("n"), F.count_if("failed").alias("failed"))
    alpha, beta = beta_prior(hosts)
    rate = (F.col("failed") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
    rates = hosts.select(F.col(host).alias("__host"), rate.alias("host_rate"))
    joined = rows.join(rates, rows[host].eqNullSafe(rates["__host"]), "left").drop("__host")
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= limits.host_rate))


#: The contract's columns in DuckDB, with the production limits.
SQL = r"""
with t as materialized (select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from documents),
g as (select doc_id, unnest(range(1, len(w) - 1)) as i, w from t where len(w) >= 3),
k as (select doc_id, i, w[i] as a, w[i + 1] as b, w[i + 2] as c from g),
d as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from k) where n > 1),
r as (select doc_id, sum(step)::bigint as n from (select doc_id, least(3, coalesce(lead(i) over (partition by doc_id order by i) - i, 3)) as step from d) group by doc_id),
m as (select t.doc_id, source, len(w)::bigint as n_words, coalesce(list_sum([length(x) for x in w]), 0)::bigint as word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols, len(l) as n_lines,
  (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words from t left join r using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
f as (select *, base_failed or 100 * n_symbols > 10 * word_chars or 100 * n_dup_lines > 30 * n_lines or word_chars < 2 * n_words or word_chars > 20 * n_words as failed from b),
h as (select source, count(*)::double as n, (count(*) filter (where failed))::double as f from f group by source),
s as (select count(*) as hosts, sum(n) as n, sum(f) as f, sum(n * n) as n2, sum(f * f / n) as f2, sum(f) / sum(n) as p from h),
q as (select p, 1 / least(greatest(case when p * (1 - p) > 0 and n - n2 / n - (hosts - 1) > 0
  then ((f2 - p * p * n) / (p * (1 - p)) - (hosts - 1)) / (n - n2 / n - (hosts - 1)) else 0 end, 1e-6), 0.999) - 1 as strength from s)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
not base_failed and (h.f + p * strength) / (h.n + strength) <= 0.5 as kept
from f join h on f.source is not distinct from h.source cross join q
"""
