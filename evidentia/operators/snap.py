"""Near values of a vocabulary of any size, through an inverted index of letters.

The measure is 2M/T with M matched letters of T. M is at most the letters two
strings share, counted with repetition, so a pair that reaches a similarity s
shares at least s * T / 2 of them, and their lengths differ by no more than the
factor (2 - s) / s. Of any two such strings the rarest letters meet: of a
string of length n only the first n - o + 1 by rarity are indexed, o being the
least overlap with the shortest partner. Pairs that meet there pass the length
and the count filter before any is scored. All filters are lossless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from evidentia.functions import similarity, text as tx
from evidentia.operators.textmodel import beside
from evidentia.session import durable

_SLACK = 1e-9


def letters(key: Column) -> Column:
    """Letters of a string with their number of occurrence: a1, b1, a2."""
    chars = F.filter(F.split(key, ""), lambda c: c != "")
    so_far = lambda c, i: F.size(F.filter(F.slice(chars, 1, i + 1), lambda x: x == c))
    return F.transform(chars, lambda c, i: F.concat(c, so_far(c, i).cast("string")))


def _least(length: Column, least: float) -> Column:
    """Letters that a string shares at least with any partner of this similarity."""
    shortest = F.ceil(length * (least / (2 - least)) - _SLACK)
    return F.ceil((length + shortest) * (least / 2) - _SLACK)


def _indexed(strings: DataFrame, rarity: DataFrame, rare_rows: int, least: float) -> DataFrame:
    """(key, size, letters, token): a row for each indexed letter of each string."""
    rows = strings.select("key", F.length("key").alias("size"), letters(F.col("key")).alias("letters"))
    rows = rows.select("key", "size", "letters", F.explode("letters").alias("token"))
    rows = rows.join(beside(rarity, rare_rows), "token", "left").groupBy("key", "size").agg(
        F.first("letters").alias("letters"), F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))).alias("order")
    )
    head = (F.col("size") - _least(F.col("size"), least) + 1).cast("int")
    return rows.select("key", "size", "letters", F.explode(F.slice("order", F.lit(1), head)).alias("o")).select("key", "size", "letters", "o.token")


def near(needles: DataFrame, options: DataFrame, least: float) -> DataFrame:
    """(key, option_key, score): all pairs of distinct keys whose similarity is at least ``least``."""
    needles = durable(needles.select("key").filter(F.col("key") != "").distinct())
    options = durable(options.select("key").filter(F.col("key") != "").distinct())
    rarity = durable(options.select(F.explode(letters(F.col("key"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    rows = rarity.count()
    a = _indexed(needles, rarity, rows, least)
    b = _indexed(options, rarity, rows, least).select(F.col("key").alias("option_key"), F.col("size").alias("b_size"), F.col("letters").alias("b_letters"), "token")
    factor = (2 - least) / least
    met = a.join(b, "token").filter(
        (F.col("size") <= F.col("b_size") * factor + _SLACK) & (F.col("b_size") <= F.col("size") * factor + _SLACK)
    )
    shared = F.size(F.array_intersect("letters", "b_letters"))
    met = met.filter(shared >= (F.col("size") + F.col("b_size")) * (least / 2) - _SLACK).select("key", "option_key").distinct()
    scored = met.withColumn("score", similarity.pair_ratio(least - _SLACK)("key", "option_key"))
    return scored.filter(F.col("score") >= least - _SLACK)


def snap(rows: DataFrame, options: DataFrame, value: str, score: float, margin: float, keep: tuple[str, ...] = ("unknown", "")) -> DataFrame:
    """``rows`` with ``value`` replaced by the option of (option) that is near enough and unrivalled.

    Equal scores go to the option that sorts last. A rival below
    ``score - margin`` changes nothing, so none below is looked for.
    """
    names = rows.columns
    options = options.select("option").distinct().withColumn("key", tx.category_key(F.col("option")))
    keyed = rows.withColumn("_key", F.when(~F.col(value).isin(*keep), tx.category_key(F.col(value))))
    pairs = near(keyed.select(F.col("_key").alias("key")).filter("key is not null"), options, score - margin)
    ranked = pairs.join(options.select("option", F.col("key").alias("option_key")), "option_key")
    order = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("option").desc())
    ranked = ranked.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= 2)
    best = ranked.groupBy("key").agg(
        F.max(F.when(F.col("r") == 1, F.col("option"))).alias("_best"),
        F.max("score").alias("_first"),
        F.coalesce(F.max(F.when(F.col("r") == 2, F.col("score"))), F.lit(0.0)).alias("_second"),
    )
    good = best.filter((F.col("_first") >= score) & (F.col("_first") - F.col("_second") >= margin)).select(F.col("key").alias("_key"), "_best")
    return keyed.join(good, "_key", "left").withColumn(value, F.coalesce("_best", value)).select(*names)
