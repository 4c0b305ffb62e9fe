"""Character n-gram models: features, vocabulary, and scoring as joins.

A model is a weight table (token, idf, coefs) with a small header. The n-grams
of a text are counted where it lies, cut down to the tokens some model knows by
joining the weight table, and folded to one row per text and model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pyspark.sql.pandas.types import to_arrow_type

from evidentia.functions import grams, text as tx
from evidentia.session import durable

GRAM_SIZES = (3, 4, 5)
#: A weight table or vocabulary is broadcast up to this many counted rows.
BROADCAST_ROWS = 250_000
LOGIT_CLAMP = 40.0

WEIGHTS = T.StructType(
    [
        T.StructField("token", T.StringType()),
        T.StructField("idf", T.DoubleType()),
        T.StructField("coefs", T.ArrayType(T.DoubleType())),
    ]
)


@dataclass(frozen=True)
class Model:
    """Exported weights of one model.

    ``classes`` is empty for a binary model, the class names of a multiclass
    one, or the flags of a multilabel one; ``coefs`` are in that order.
    """

    weights: DataFrame
    intercepts: tuple[float, ...]
    max_features: int
    classes: tuple[str, ...] = ()
    threshold: float = 1.0
    minimum_probability: float = 1.0
    minimum_margin: float = 1.0
    thresholds: dict[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class Models:
    """The models a pipeline may use; a missing one leaves its branch inert."""

    denial: Model | None = None
    approval: Model | None = None
    fee: Model | None = None
    risk: Model | None = None
    categories: dict[str, Model] = field(default_factory=dict)


# -- features --------------------------------------------------------------


def term_counts(texts: DataFrame, keys: list[str], text: str = "text", sizes: tuple[int, ...] = GRAM_SIZES) -> DataFrame:
    """Occurrences of each n-gram of a key, over all its texts.

    The texts are brought together by key, which moves nothing if they are
    partitioned by it, and counted in a task; no n-gram is shuffled.
    """
    order = Window.partitionBy(*keys).orderBy(*keys)
    rows = texts.select(*keys, (F.row_number().over(order) == 1).alias("first"), F.col(text).alias("text"))
    schema = T.StructType([*texts.select(*keys).schema, T.StructField("token", T.StringType()), T.StructField("tf", T.LongType())])
    return rows.withColumn("text", tx.mask_digits(F.col("text"))).mapInArrow(grams.counter(sizes), schema)


@dataclass(frozen=True)
class Grams:
    """n-grams of all texts of a key, counted where they are asked for and never as rows of their own.

    The operators that take counts (key, token, tf) take these as well: one
    sums them up by token in its tasks, another counts the known tokens alone.
    """

    texts: DataFrame
    keys: list[str]
    words: bool = False
    text: str = "text"

    @property
    def sizes(self) -> tuple[int, ...]:
        return (1, 2) if self.words else GRAM_SIZES

    def counts(self) -> DataFrame:
        """Rows (keys, token, tf), for vocabularies too large to be looked up in place."""
        if self.words:
            return word_ngrams(self.texts, self.keys, self.text, self.sizes).groupBy(*self.keys, "token").agg(F.count(F.lit(1)).alias("tf"))
        return term_counts(self.texts, self.keys, self.text)

    def finder(self, tokens: list[str]) -> grams.Finder | grams.WordFinder:
        return (grams.WordFinder if self.words else grams.Finder)(tokens, self.sizes)

    def gathered(self, *others: str, texts: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
        """(others, first, masked text), the texts of a key (and ``by``) one behind the other."""
        own = [*self.keys, *by]
        first = F.row_number().over(Window.partitionBy(*own).orderBy(*own)) == 1
        masked = F.coalesce(tx.mask_digits(F.col(self.text)), F.lit(""))
        return (self.texts if texts is None else texts).select(*others, first.alias("first"), masked.alias("text"))

    def profile(self, gathered: DataFrame) -> DataFrame:
        """(token, fold, df, cf), parts of sums over (fold, first, text)."""
        return gathered.mapInArrow(grams.profiler(self.sizes, self.words), "token string, fold long, df long, cf long")


def per_key(find, make: Callable, names: list[str]) -> Callable:
    """Function over Arrow batches (others, first, text): ``make(others of each key, ends, places, occurrences)`` gives a batch's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in grams.vectors(batches, find):
            yield pa.RecordBatch.from_arrays(make(*found), names)

    return run


def word_ngrams(texts: DataFrame, keys: list[str], text: str = "text", sizes: tuple[int, ...] = (1, 2)) -> DataFrame:
    """One row per run of ``n`` words of the masked text, for each size."""
    words = F.filter(F.split(tx.mask_digits(F.col(text)), " "), lambda w: w != "")
    rows = texts.select(*keys, words.alias("w"))

    def run_of(n: int):
        return lambda x, i: F.array_join(F.slice("w", i + 1, n), " ")

    runs = [
        F.when(
            F.size("w") >= n,
            F.transform(F.slice("w", 1, F.greatest(F.size("w") - n + 1, F.lit(0))), run_of(n)),
        ).otherwise(F.array().cast("array<string>"))
        for n in sizes
    ]
    return rows.select(*keys, F.explode(F.concat(*runs)).alias("token"))


def hybrid_counts(texts: DataFrame, keys: list[str], chars: tuple[int, ...] = (2, 3, 4, 5, 6), words: tuple[int, ...] = (1, 2), text: str = "text") -> DataFrame:
    """Term counts over character and word n-grams in one vocabulary: tokens are told apart by a prefix."""
    c = term_counts(texts, keys, text, chars)
    w = word_ngrams(texts, keys, text, words).groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("tf"))
    told = lambda counts, prefix: counts.withColumn("token", F.concat(F.lit(prefix), "token"))
    return told(c, "c:").unionByName(told(w, "w:"))


def document_frequencies(counts: DataFrame | Grams, *sums: str) -> DataFrame:
    """Texts and occurrences per token, and totals of the columns ``sums``; ``counts`` holds a text's token once."""
    if isinstance(counts, Grams):
        parts = counts.profile(counts.gathered(F.lit(0).alias("fold")))
        return parts.groupBy("token").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    return counts.groupBy("token").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("cf"), *[F.sum(c).alias(c) for c in sums]
    )


def vocabulary(counts: DataFrame | Grams, documents: int, min_df: int, max_features: int, *sums: str) -> DataFrame:
    """Tokens in at least ``min_df`` texts, the ``max_features`` most frequent, with idf and ``sums``."""
    frequent = durable(document_frequencies(counts, *sums).filter(F.col("df") >= min_df))
    return most_frequent(frequent, max_features).withColumn("idf", F.log(F.lit(1.0 + documents) / (1.0 + F.col("df"))) + 1.0)


def step_of(n: Column) -> Column:
    """Counts in steps of a 32nd of a power of two: two thousand steps hold every long."""
    return F.floor(F.log2(n.cast("double")) * 32).cast("int")


def cut_off(steps: list[tuple[int, int]], wanted: int) -> int:
    """The step from which on the highest counts number ``wanted`` or more; (step, rows) in any order."""
    for step, rows in sorted(steps, reverse=True):
        wanted -= rows
        if wanted <= 0:
            return step
    return min((s for s, _ in steps), default=0)


def most_frequent(rows: DataFrame, wanted: int, count: str = "cf", tie: str = "token") -> DataFrame:
    """The ``wanted`` rows of highest count, ties to the smaller ``tie``.

    A histogram of the counts gives a cut-off first, so that one task sorts
    little more than ``wanted`` rows. Read twice: ``rows`` should be stored.
    """
    step = step_of(F.col(count))
    steps = [(r["s"], r["n"]) for r in rows.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()]
    return rows.filter(step >= cut_off(steps, wanted)).orderBy(F.col(count).desc(), F.col(tie)).limit(wanted)


def beside(table: DataFrame, rows: int) -> DataFrame:
    """A table of ``rows`` counted rows as the small side of a join: broadcast, or hashed partition by partition."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table.hint("shuffle_hash")


def sublinear(tf: Column) -> Column:
    return 1.0 + F.log(tf.cast("double"))


def tfidf(counts: DataFrame | Grams, vocab: DataFrame, keys: list[str]) -> DataFrame:
    """L2-normalised sublinear TF-IDF weights over vocabulary tokens only."""
    vocab = durable(vocab.select("token", "idf"))
    if isinstance(counts, Grams):
        known = [(r["token"], r["idf"]) for r in vocab.collect()] if vocab.count() <= BROADCAST_ROWS else None
        find = known is not None and counts.finder([t for t, _ in known])
        if not find or find.cells > grams.Finder.MOST:
            return tfidf(counts.counts(), vocab, keys)
        return _weighted(counts, find, np.array([i for _, i in known], dtype="float64"))
    raw = counts.join(beside(vocab, vocab.count()), "token").withColumn("raw", sublinear(F.col("tf")) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(*keys)))
    return raw.select(*keys, "token", (F.col("raw") / norm).alias("weight"))


def _weighted(counted: Grams, find, idf: np.ndarray) -> DataFrame:
    """Weights of all tokens of a text as they are found: no row of a token moves."""
    tokens = pa.array(find.listed, pa.string())
    kinds = [counted.texts.schema[k] for k in counted.keys]
    types = [to_arrow_type(k.dataType) for k in kinds]

    def make(held, ends, place, n) -> list[pa.Array]:
        raw = (1.0 + np.log(n)) * idf[place]
        sizes = np.diff(ends, prepend=0)
        norm = np.sqrt(grams.folded(raw * raw, ends))
        rows = pa.array(np.repeat(np.arange(len(held)), sizes))
        keys = [pa.array(c, t).take(rows) for c, t in zip(zip(*held), types)]
        return [*keys, tokens.take(pa.array(place)), pa.array(raw / np.repeat(norm, sizes))]

    schema = T.StructType([*kinds, T.StructField("token", T.StringType()), T.StructField("weight", T.DoubleType())])
    return counted.gathered(*counted.keys).mapInArrow(per_key(find, make, schema.names), schema)


# -- scoring ---------------------------------------------------------------


def sigmoid(score: Column) -> Column:
    clamped = F.greatest(F.lit(-LOGIT_CLAMP), F.least(F.lit(LOGIT_CLAMP), score))
    return 1.0 / (1.0 + F.exp(-clamped))


def raw_scores(texts: DataFrame, keys: list[str], models: dict[str, Model], text: str = "text") -> DataFrame:
    """One row per text: an array ``<model>`` with the linear scores of a model.

    All models share one count of n-grams and one table of their tokens. n-grams
    that no model knows go before the shuffle if that table is small enough to
    be broadcast (its rows are counted). Texts without a known token score the intercepts alone, so they
    are kept by an outer join on the keys.
    """
    tables = [
        m.weights.select("token", F.struct(F.lit(i).alias("model"), "idf", F.col("coefs").cast("array<double>").alias("coefs")).alias("w"))
        for i, m in enumerate(models.values())
    ]
    weights = tables[0]
    for table in tables[1:]:
        weights = weights.unionAll(table)
    weights = weights.groupBy("token").agg(F.collect_list("w").alias("w")).withColumn("number", F.monotonically_increasing_id())
    weights = durable(weights)
    rows = weights.count()
    near = _scored_in_place(texts, keys, models, text, weights) if rows <= BROADCAST_ROWS else None
    if near is not None:
        return near
    tokens, values = (beside(weights.select(c, "number"), rows) for c in ("token", "w"))
    known = term_counts(texts, keys, text).join(tokens, "token").drop("token")
    known = known.join(values, "number").select(*keys, "tf", F.explode("w").alias("w"))
    value = sublinear(F.col("tf")) * F.col("w.idf")
    mine = lambda i, x: F.sum(F.when(F.col("w.model") == i, x))
    sums = [
        (mine(i, value * F.get("w.coefs", F.lit(j))) / F.sqrt(mine(i, value * value))).alias(f"{name}:{j}")
        for i, (name, m) in enumerate(models.items())
        for j in range(len(m.intercepts))
    ]
    per_model = known.groupBy(*keys).agg(*sums)
    every = texts.select(*keys).distinct().join(per_model, keys, "left")
    return every.select(
        *keys,
        *[
            F.array(
                *[
                    F.coalesce(F.col(f"`{name}:{i}`"), F.lit(0.0)) + float(b)
                    for i, b in enumerate(m.intercepts)
                ]
            ).alias(name)
            for name, m in models.items()
        ],
    )


def _scored_in_place(texts: DataFrame, keys: list[str], models: dict[str, Model], text: str, weights: DataFrame) -> DataFrame | None:
    """``raw_scores`` where the n-grams are counted, so that only scores leave a task; None if the tokens are too many for it."""
    known = weights.select("token", "w").collect()
    counted = Grams(texts, keys, text=text)
    find = counted.finder([r["token"] or "" for r in known])
    if find.cells > grams.Finder.MOST or any(len({w["model"] for w in r["w"]}) < len(r["w"]) for r in known):
        return None
    tables = [(np.zeros(len(known)), np.zeros((len(known), len(m.intercepts)))) for m in models.values()]
    for place, r in enumerate(known):
        for w in r["w"]:
            idf, coefs = tables[w["model"]]
            idf[place] = w["idf"] or 0.0
            own = [c or 0.0 for c in (w["coefs"] or [])[: coefs.shape[1]]]
            coefs[place, : len(own)] = own
    bare = [np.array(m.intercepts, dtype="float64") for m in models.values()]
    kinds = [texts.schema[k] for k in keys]
    types = [to_arrow_type(k.dataType) for k in kinds]

    def make(held, ends, place, n) -> list[pa.Array]:
        out = [pa.array(c, t) for c, t in zip(zip(*held), types)]
        keyed = ~np.array([None in own for own in held])
        for (idf, coefs), intercepts in zip(tables, bare):
            raw = (1.0 + np.log(n)) * idf[place]
            norm = np.sqrt(grams.folded(raw * raw, ends))
            own = np.stack([grams.folded(raw * c[place], ends) for c in coefs.T], axis=1) / np.where(norm > 0, norm, 1.0)[:, None]
            scores = np.where(keyed[:, None], own, 0.0) + intercepts
            ends_of = np.arange(len(held) + 1, dtype="int32") * len(intercepts)
            out.append(pa.ListArray.from_arrays(pa.array(ends_of), pa.array(scores.ravel())))
        return out

    schema = T.StructType([*kinds, *(T.StructField(n, T.ArrayType(T.DoubleType())) for n in models)])
    return counted.gathered(*keys).mapInArrow(per_key(find, make, schema.names), schema)


def binary_probability(scores: Column) -> Column:
    return sigmoid(scores[0])


def multiclass(scores: Column, model: Model) -> Column:
    """Struct (value, probability, margin, accepted) of a one-vs-rest model."""
    raw = F.transform(scores, sigmoid)
    total = F.aggregate(raw, F.lit(0.0), lambda a, b: a + b)
    ranked = F.sort_array(
        F.zip_with(
            raw,
            F.array(*[F.lit(c) for c in model.classes]),
            lambda p, c: F.struct((p / total).alias("probability"), c.alias("value")),
        ),
        asc=False,
    )
    best, margin = ranked[0], ranked[0]["probability"] - ranked[1]["probability"]
    return F.struct(
        best["value"].alias("value"),
        best["probability"].alias("probability"),
        margin.alias("margin"),
        (
            (best["probability"] >= model.minimum_probability) & (margin >= model.minimum_margin)
        ).alias("accepted"),
    )


def multilabel(scores: Column, model: Model) -> Column:
    """Flags whose own probability reaches their own threshold, joined by '|'."""
    flags = sorted(range(len(model.classes)), key=lambda i: model.classes[i])
    return F.concat_ws(
        "|",
        *[
            F.when(
                sigmoid(scores[i]) >= model.thresholds.get(model.classes[i], 1.0),
                F.lit(model.classes[i]),
            )
            for i in flags
        ],
    )


_NO_CLASS = (
    "named_struct('value', '', 'probability', 0.0D, 'margin', 0.0D, 'accepted', false)"
)


def _bare(model: Model) -> Column:
    """What a binary model says of a case without any text: its intercept alone."""
    return binary_probability(F.array(F.lit(float(model.intercepts[0]))))


def add_model_scores(cases: DataFrame, texts: DataFrame, models: Models | None) -> DataFrame:
    """Score columns of every model on the cases, inert values for missing models."""
    models = models or Models()
    present = {
        "denial": models.denial,
        "approval": models.approval,
        "fee_status": models.fee,
        "risk": models.risk,
        **models.categories,
    }
    present = {name: m for name, m in present.items() if m is not None}
    if present:
        cases = cases.join(raw_scores(texts, ["case_id"], {f"m_{n}": m for n, m in present.items()}), "case_id", "left")

    def binary(name: str, model: Model | None) -> dict[str, Column]:
        if model is None:
            return {name: F.lit(0.0), f"{name}_threshold": F.lit(1.0)}
        return {
            name: F.coalesce(binary_probability(F.col(f"m_{name}")), _bare(model)),
            f"{name}_threshold": F.lit(float(model.threshold)),
        }

    def classes(name: str) -> Column:
        inert = F.expr(_NO_CLASS)
        model = present.get(name)
        return inert if model is None else F.coalesce(multiclass(F.col(f"m_{name}"), model), inert)

    risk = (
        F.lit("")
        if models.risk is None
        else F.coalesce(multilabel(F.col("m_risk"), models.risk), F.lit(""))
    )
    scored = cases.withColumns(
        {
            **binary("denial", models.denial),
            **binary("approval", models.approval),
            "fee_model": classes("fee_status"),
            "risk_model": risk,
            **{
                f"{n}_model": classes(n)
                for n in ("declared_purpose", "visa_class", "species_code", "home_world")
            },
        }
    )
    return scored.drop(*[f"m_{n}" for n in present])


def export_error(expected: DataFrame, observed: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Largest difference between trained and re-scored probabilities."""
    other = observed.select(*keys, F.col(column).alias("observed"))
    return expected.join(other, keys).agg(
        F.max(F.abs(F.col(column) - F.col("observed"))).alias("maximum_error"),
        F.count(F.lit(1)).alias("compared"),
    )
