"""Mixing sources to target weights by Poisson replication.

Every document is repeated Poisson(rate) times, where the rate is the number of
repetitions that its source needs to reach its share of the target size. The
Poisson variable is the inverse distribution function at a uniform number
hashed from (seed, document), so a rerun, a retried task or another cluster
gives the same copies. The copies are exploded and shuffled globally by a
hashed key.

Skew: rows are never grouped by source. Sizes are sums (partial aggregation
first), the table of distribution functions has one row per source and is
joined to the documents as Spark sees fit (broadcast below its own size limit,
else a join whose hot partitions are split).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from evidentia.llm.common import fingerprint, stored

SCALE = float(1 << 52)


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def tempered_weights(docs: DataFrame, exponent: float = 0.7) -> DataFrame:
    """(source, weight): shares proportional to bytes ** exponent. A source without bytes weighs 0."""
    sizes = docs.groupBy("source").agg(F.sum(text_bytes(F.col("text"))).alias("bytes"))
    return sizes.select("source", F.pow(F.col("bytes").cast("double"), F.lit(exponent)).alias("weight"))


def repetition_rates(docs: DataFrame, weights: DataFrame, epochs: float = 1.0) -> DataFrame:
    """(source, bytes, rate): mean repetitions of a document of the source.

    ``weights`` (source, weight) need not sum to 1; weights of a source are
    added up. The target size is ``epochs`` times all bytes. A source without
    weight, with a null or non-positive one, or without bytes has rate 0.
    """
    sizes = docs.groupBy("source").agg(F.sum(text_bytes(F.col("text"))).alias("bytes"))
    wanted = weights.where("weight > 0 and weight < double('inf')").groupBy("source").agg(F.sum("weight").alias("weight"))
    wanted = wanted.withColumnRenamed("source", "wanted_source")
    rows = sizes.join(wanted, sizes["source"].eqNullSafe(wanted["wanted_source"]), "left").drop("wanted_source")
    rows = rows.withColumn("weight", F.when(F.col("bytes") > 0, F.coalesce("weight", F.lit(0.0))).otherwise(0.0))
    # two sums over the sources, one row: the only numbers the driver sees
    total = rows.agg(F.sum("bytes").alias("bytes"), F.sum("weight").alias("weight")).first()
    factor = epochs * float(total["bytes"] or 0) / (total["weight"] or 1.0)
    return rows.select(
        "source",
        "bytes",
        F.when(F.col("bytes") > 0, F.col("weight") * F.lit(factor) / F.col("bytes")).otherwise(0.0).alias("rate"),
    )


def distribution_functions(rates: DataFrame) -> DataFrame:
    """(source, cdf): P(X <= k) of Poisson(rate) for k = 0, 1, ... until the tail is below 2 ** -60.

    In logarithms, so that large rates don't underflow.
    """
    last = F.ceil(F.col("rate") + 10 * F.sqrt("rate") + 30).cast("int")
    terms = rates.select("source", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    key = Window.partitionBy("source", "rate").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    log_factorial = F.sum(F.log(F.greatest("k", F.lit(1)).cast("double"))).over(key)
    mass = F.when(F.col("rate") > 0, F.exp(F.col("k") * F.log("rate") - F.col("rate") - log_factorial))
    terms = terms.withColumn("mass", F.coalesce(mass, (F.col("k") == 0).cast("double")))
    terms = terms.withColumn("cdf", F.sum("mass").over(key))
    pairs = F.array_sort(F.collect_list(F.struct("k", "cdf")))
    return terms.groupBy("source").agg(F.transform(pairs, lambda p: p["cdf"]).alias("cdf"))


def mix(docs: DataFrame, weights: DataFrame, epochs: float = 1.0, seed: int = 17) -> DataFrame:
    """Columns of ``docs``, plus copy (from 1) and mix_key (long), globally shuffled.

    Rows of a partition are sorted by mix_key and rows are dealt to partitions
    by its hash, so the files in any order are a random permutation.

    Null source: a source of its own. Null or empty text: no bytes, repeated at
    the rate of its source. Null doc_id: hashed like the empty string. Rows
    with the same doc_id get the same count. Empty input: empty result. Other
    columns pass through; docs' own columns copy or mix_key are replaced.
    """
    docs = docs.drop("copy", "mix_key")
    functions = distribution_functions(stored(repetition_rates(docs, weights, epochs)))
    functions = functions.select(F.col("source").alias("__source"), F.col("cdf").alias("__cdf"))
    key = F.coalesce(docs["doc_id"].cast("string"), F.lit(""))
    uniform = fingerprint(F.concat(F.lit(f"{seed}:count:"), key)) / F.lit(SCALE)
    rows = docs.join(functions, docs["source"].eqNullSafe(functions["__source"]), "inner")
    # the count is the number of values below the uniform number: its place among them
    count = F.array_position(F.array_sort(F.array_append("__cdf", F.col("__u"))), F.col("__u")) - 1
    rows = rows.withColumn("__u", uniform).withColumn("__n", count).where("__n > 0").drop("__cdf", "__u", "__source")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).drop("__n")
    place = F.concat(F.lit(f"{seed}:place:"), key, F.lit(":"), F.col("copy").cast("string"))
    rows = rows.withColumn("mix_key", fingerprint(place, 15))
    return rows.repartition("mix_key").sortWithinPartitions("mix_key")


#: The same in DuckDB, for weights bytes ** 0.7, one epoch and seed 17.
SQL = """
with sizes as (select source, sum(coalesce(strlen(text), 0))::double as bytes from documents group by source),
w as (select source, bytes, pow(bytes, 0.7) as weight from sizes),
r as (select source, case when bytes > 0 then weight * ((select sum(bytes) from w) / (select sum(weight) from w)) / bytes else 0 end as rate from w),
t as (select source, rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 30)::int + 1)) as k from r),
f as (select *, sum(ln(greatest(k, 1)::double)) over (partition by source order by k) as lf from t),
m as (select source, k, case when rate > 0 then exp(k * ln(rate) - rate - lf) else (k = 0)::int::double end as mass from f),
c as (select source, k, sum(mass) over (partition by source order by k) as cdf from m),
u as (select *, ('0x' || substr(md5('17:count:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint / pow(2, 52) as u from documents),
n as (select u.doc_id, u.source, u.text, u.lang, u.n_chars, count(*) as n from u join c on u.source is not distinct from c.source and c.cdf < u.u group by all),
e as (select *, unnest(range(1, n + 1)) as copy from n)
select doc_id, text, lang, source, n_chars, copy::int as copy,
('0x' || substr(md5('17:place:' || coalesce(doc_id::varchar, '') || ':' || copy), 1, 15))::bigint as mix_key from e
"""
