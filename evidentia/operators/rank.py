"""Ranking, ordered sweeps and splits that never sort all rows in one task.

A global running total is taken in two levels: rows are folded to distinct
scores, scores are cut into ranges of similar weight, running totals are
taken inside each range, and every range is offset by the totals of the
ranges before it. The ranges affect balance only, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

def top_two(scores: Column) -> tuple[Column, Column]:
    """Best and margin of an array of (score, value) structs; ties go to the later value."""
    ranked = F.sort_array(scores, asc=False)
    return ranked[0], ranked[0]["score"] - F.coalesce(F.get(ranked, F.lit(1))["score"], F.lit(0.0))


def first_n(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """First ``n`` rows per key; the row limit is applied before the shuffle too."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", position).filter(F.col("_n") <= n).drop("_n")


def _range_of(column: str, edges: list) -> Column:
    """Edges below the value: its place among them."""
    if not edges:
        return F.lit(0)
    value = F.col(column).cast("double")
    every = F.array_sort(F.array_append(F.array(*[F.lit(float(e)) for e in edges]), value))
    return (F.array_position(every, value) - 1).cast("int")


def top_candidates(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first ``n`` rows in a lexicographic order; each task keeps ``n`` at most."""
    return df.orderBy(*order).limit(n)


def middle(*columns: Column) -> Column:
    """Median of several numbers of a row."""
    ranked, n = F.array_sort(F.array(*columns)), len(columns)
    return (ranked[(n - 1) // 2] + ranked[n // 2]) / 2


def running_sums(
    histogram: DataFrame, score: str, sums: list[str], descending: bool = False, ranges: int | None = None
) -> DataFrame:
    """Adds ``cum_<name>``: totals over all scores up to and including each one.

    ``histogram`` has one row per distinct score. The range edges are at most
    ``ranges`` numbers (one for each shuffle partition unless given) and the
    range totals at most as many rows.
    """
    ranges = ranges or max(2, int(histogram.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    steps = [i / ranges for i in range(1, ranges)]
    edges = sorted(set(histogram.approxQuantile(score, steps, 0.01)))
    ranged = histogram.withColumn("_range", _range_of(score, edges))
    order = F.desc if descending else F.asc
    totals = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    before = (
        Window.partitionBy(F.lit(0)).orderBy(order("_range")).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        "_range", *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums]
    )
    inside = (
        Window.partitionBy("_range")
        .orderBy(order(score))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = ranged.join(F.broadcast(offsets), "_range")
    return joined.withColumns(
        {f"cum_{c}": F.sum(c).over(inside) + F.col(f"_off_{c}") for c in sums}
    ).drop("_range", *[f"_off_{c}" for c in sums])


def average_rank(df: DataFrame, score: str, alias: str) -> DataFrame:
    """Average-tie rank of ``score`` among the rows that have one, divided by their number; else null."""
    histogram = df.where(F.col(score).isNotNull()).groupBy(score).agg(F.count(F.lit(1)).alias("n"))
    total = df.where(F.col(score).isNotNull()).count()
    ranked = running_sums(histogram, score, ["n"]).select(
        score, ((F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2.0) / F.lit(total)).alias(alias)
    )
    return df.join(ranked, score, "left")


def threshold_sweep(df: DataFrame, score: str, label: str, classes: tuple[str, ...]) -> DataFrame:
    """Per distinct score, the class counts of all rows scoring at least that."""
    histogram = df.groupBy(score).agg(
        *[F.count_if(F.col(label) == c).alias(c.lower()) for c in classes]
    )
    return running_sums(histogram, score, [c.lower() for c in classes], descending=True)


def best_threshold(sweep: DataFrame, score: str) -> DataFrame:
    """Best net recovery among thresholds that approve no denied row."""
    net = F.col("cum_approved") - F.col("cum_needs_review")
    safe = sweep.filter(F.col("cum_denied") == 0)
    return safe.agg(
        F.max(
            F.struct(
                net.alias("net"),
                F.col("cum_approved").alias("recovered"),
                (-F.col("cum_needs_review")).alias("minus_errors"),
                F.col(score).alias("threshold"),
            )
        ).alias("best")
    ).select("best.net", "best.recovered", (-F.col("best.minus_errors")).alias("review_errors"), "best.threshold")


def hash_half(key: Column) -> Column:
    """0 = development, 1 = holdout, by the first 32 bits of the key's SHA-256."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") % 2


def stratified_folds(df: DataFrame, key: str, stratum: str, folds: int = 5, cells: int = 256) -> DataFrame:
    """Adds ``fold``: position in key-hash order within the stratum, modulo ``folds``.

    The order is cut into ``cells`` equal ranges of hashes, so that a stratum holding most
    of the rows is still ranked in as many parts; their number never changes the result.
    """
    hashed = df.withColumn("_h", F.sha2(F.col(key).cast("string"), 256)).withColumn(
        "_cell", F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long") * cells / F.lit(1 << 32)).cast("int")
    )
    sizes = hashed.groupBy(stratum, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(stratum).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        stratum, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    inside = F.row_number().over(Window.partitionBy(stratum, "_cell").orderBy("_h"))
    placed = hashed.withColumn("_r", inside).join(offsets, [stratum, "_cell"])
    return placed.withColumn("fold", ((F.col("_off") + F.col("_r") - 1) % folds).cast("int")).drop(
        "_h", "_cell", "_r", "_off"
    )
