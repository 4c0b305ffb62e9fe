"""Word boxes to text, label anchors and value regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from evidentia import policy as fixed
from evidentia.functions import similarity, text as tx
from evidentia.policy import DEFAULT, Policy

LINE = ("case_id", "page", "block", "paragraph", "line")
#: Words of the longest span that is held against labels.
MOST_WORDS = 3


def valid_words(words: DataFrame) -> DataFrame:
    """Words with text, a non-negative confidence and a real box."""
    return words.withColumn("text", tx.normalize_space(F.col("text"))).filter(
        (F.col("text") != "") & (F.col("confidence") >= 0) & (F.col("width") > 0) & (F.col("height") > 0)
    )


def parse_word_rows(rows: DataFrame, column: str) -> DataFrame:
    """Words from tab-separated rows (left, top, width, height, block, paragraph,
    line, confidence, text); malformed rows yield NULL numbers and drop out."""
    # out of a generator, below which no filter goes: pushed down, each of a dozen conditions would make and split the row anew
    rows = rows.select("*", F.explode_outer(F.array(F.split(column, "\t"))).alias("__parts"))
    parts = F.col("__parts")
    names = ("left", "top", "width", "height", "block", "paragraph", "line")
    parsed = rows.withColumns(
        {
            **{n: F.get(parts, F.lit(i)).try_cast("int") for i, n in enumerate(names)},
            "confidence": F.get(parts, F.lit(7)).try_cast("double"),
            "text": F.get(parts, F.lit(8)),
        }
    ).drop("__parts").dropna(subset=[*names, "confidence"])
    return valid_words(parsed)


def page_text(words: DataFrame) -> DataFrame:
    """Text of a page in reading order and its mean word confidence.

    Two levels, so that a line and then a page is the largest thing gathered.
    """
    lines = words.groupBy(*LINE).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("left", "text"))), lambda w: w["text"]), " "
        ).alias("line_text"),
        F.sum("confidence").alias("c"),
        F.count(F.lit(1)).alias("n"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("block", "paragraph", "line", "line_text")))
    return lines.groupBy("case_id", "page").agg(
        F.array_join(F.transform(ordered, lambda r: r["line_text"]), "\n").alias("text"),
        F.round(F.sum("c") / F.sum("n"), 3).alias("quality"),
    )


def page_diagnostics(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Contrast, dark fraction and edge variance from (gray, edge) pixel values."""
    return pixels.groupBy(*keys).agg(
        F.round(F.stddev_pop("gray"), 3).alias("grayscale_contrast"),
        F.round(F.count_if(F.col("gray") < 96) / F.count(F.lit(1)), 5).alias("dark_pixel_fraction"),
        F.round(F.var_pop("edge"), 3).alias("edge_variance"),
    )


def anchor_similarity(observed: Column, expected: Column, floor: float = 0.0) -> Column:
    """1.0 when the folded label is contained, else the matching-blocks measure."""
    actual, target = tx.anchor_text(observed), tx.anchor_text(expected)
    usable = (actual != "") & (target != "")
    held = F.contains(actual, target)
    near = similarity.pair_ratio(floor)(F.when(usable & ~held, actual), target)
    return F.when(~usable, 0.0).when(held, 1.0).otherwise(near)


def label_spans(words: DataFrame) -> DataFrame:
    """Every run of one to three words of a line as one row with its text and box.

    Words of a line are numbered from the left; a run is a word and those that a
    window finds behind it, so no row holds a line.
    """
    order = Window.partitionBy(*LINE).orderBy("left", "text", "top", "width", "height")
    word = F.struct(
        "text", "top", (F.col("left") + F.col("width")).alias("right"), (F.col("top") + F.col("height")).alias("bottom")
    )
    behind = {f"_{i}": F.lead(word, i).over(order) for i in range(1, MOST_WORDS)}
    joined = words.withColumns({"start": F.row_number().over(order) - 1, "_0": word, **behind})
    run = F.filter(F.array(*[f"_{i}" for i in range(MOST_WORDS)]), lambda x: x.isNotNull())
    rows = joined.withColumn("run", run).withColumn("count", F.explode(F.sequence(F.lit(1), F.size("run"))))
    rows = rows.withColumn("span", F.slice("run", 1, F.col("count")))
    return rows.select(
        *[c for c in words.columns if c not in ("text", "confidence", "left", "top", "width", "height")],
        "start",
        "count",
        F.array_join(F.transform("span", lambda x: x["text"]), " ").alias("span_text"),
        F.array_min(F.transform("span", lambda x: x["top"])).alias("top"),
        F.array_max(F.transform("span", lambda x: x["right"])).alias("right"),
        F.array_max(F.transform("span", lambda x: x["bottom"])).alias("bottom"),
    )


def propose_regions(
    words: DataFrame,
    page_width: int | Column,
    page_height: int | Column,
    layout: str | Column = "other",
    policy: Policy = DEFAULT,
) -> DataFrame:
    """Value regions right of and below label-like spans, at most two per page and field.

    Sizes and layout are values, or columns of ``words`` for pages of their own.
    A span competes only with labels of about its length (the length bound of
    the measure), so a line yields few scored pairs.
    """
    sizes = {"page_width": page_width, "page_height": page_height, "layout": layout}
    sizes = {n: v if isinstance(v, Column) else F.lit(v) for n, v in sizes.items()}
    labels = [
        (field, label, len(label.split()), order)
        for field, group in fixed.ANCHOR_LABELS.items()
        for order, label in enumerate(group)
    ]
    label_rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"), F.lit(l).alias("label"), F.lit(n).alias("size"), F.lit(o).alias("order")
            )
            for f, l, n, o in labels
        ]
    )
    placed = words.select(*LINE, "text", "left", "top", "width", "height", *[c.alias(n) for n, c in sizes.items()])
    spans = label_spans(placed).withColumn("segment", tx.anchor_text(F.col("span_text")))
    match = similarity.label_matches([(l, n) for _, l, n, _ in labels], policy.anchor_score)
    # explode_outer: plain explode would score every span a second time in a pushed-down filter
    pairs = spans.select("*", F.explode_outer(match("segment", "count")).alias("m")).filter(F.col("m").isNotNull())
    scored = pairs.withColumns({"l": F.get(label_rows, F.col("m.place")), "quality": F.col("m.quality")})
    best = scored.groupBy(*LINE, F.col("l.field").alias("field")).agg(
        F.max_by(
            F.struct("quality", "top", "right", "bottom", *sizes),
            F.struct(
                "quality",
                F.col("l.size").alias("size"),
                (-F.abs(F.col("count") - F.col("l.size"))).alias("fit"),
                (-F.col("l.order")).alias("order"),
                (-F.col("start")).alias("start"),
                (-F.col("count")).alias("count"),
            ),
        ).alias("b")
    )
    from evidentia.operators.rank import first_n

    kept = first_n(best, ["case_id", "page", "field"], ["block", "paragraph", "line"], policy.proposals_per_field)
    in_order = F.sort_array(F.collect_list(F.struct("left", "text", "top", "width", "height")))
    lines = words.groupBy(*LINE).agg(F.array_join(F.transform(in_order, lambda w: w["text"]), " ").alias("anchor_text"))
    height = F.greatest(F.lit(1), F.col("b.bottom") - F.col("b.top"))
    beside = F.col("b.right") + F.greatest(F.lit(1), F.floor(height / 3).cast("int"))
    box = F.struct(
        F.least(F.col("b.page_width"), beside).alias("left"),
        F.greatest(F.lit(0), F.col("b.top") - height).alias("top"),
        F.col("b.page_width").alias("right"),
        F.least(F.col("b.page_height"), F.col("b.bottom") + height * 5).alias("bottom"),
    )
    return kept.join(lines, list(LINE)).select(
        "case_id",
        "page",
        F.col("field").alias("field_or_section"),
        box.alias("bounding_region"),
        "anchor_text",
        F.round("b.quality", 3).alias("anchor_quality"),
        F.col("b.layout").alias("layout_family"),
        F.lit("label_value_roi").alias("proposed_reader"),
    )


def first_valid_read(reads: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """The retry ladder: reads up to and including the first valid one.

    A retry counts only when every earlier read of the crop was invalid.
    """
    first = reads.groupBy(*keys).agg(
        F.min(F.when(F.col(value) != "", F.col(order))).alias("_first")
    )
    kept = reads.join(first, keys).filter(
        F.col("_first").isNull() | (F.col(order) <= F.col("_first"))
    )
    return kept.drop("_first")
