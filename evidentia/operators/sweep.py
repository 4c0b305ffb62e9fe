"""Parameter sweeps over folded cells.

A grid is never crossed with the rows. A row matters to a threshold only by
which side of it the row falls on, so rows are first folded to cells (how many
thresholds of each kind they pass) and the grid is expanded on the cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

CLASSES = ("APPROVED", "NEEDS_REVIEW", "DENIED")


def passed(score: Column, thresholds: Sequence[float], at_most: bool = False) -> Column:
    """How many of the thresholds a score passes (>= each, or <= each)."""
    out = F.lit(0)
    for t in thresholds:
        hit = (score <= F.lit(t)) if at_most else (score >= F.lit(t))
        out = out + F.when(hit, 1).otherwise(0)
    return out


def satisfied(level: Column, thresholds: Sequence[float], at_most: bool = False) -> Column:
    """The thresholds a cell of that level passes: the loosest ``level`` of them."""
    loose_first = sorted(thresholds, reverse=at_most)
    return F.slice(F.array(*[F.lit(t) for t in loose_first]), F.lit(1), level)


def expand(cells: DataFrame, axes: dict[str, Column]) -> DataFrame:
    for name, values in axes.items():
        cells = cells.withColumn(name, F.explode(values))
    return cells


def full_grid(df: DataFrame, axes: dict[str, Sequence]) -> DataFrame:
    """Every grid point, as rows exploded from one row of literals."""
    one = df.sparkSession.range(1).select()
    return expand(one, {n: F.array(*[F.lit(v) for v in values]) for n, values in axes.items()})


def route_utility(
    rows: DataFrame,
    *,
    completes: Sequence[int],
    denial_max: Sequence[float],
    approval_min: Sequence[float],
) -> DataFrame:
    """Class counts per half and raw gain of every approval-routing rule.

    ``rows``: eligible, complete (a count), denial, approval, bio_none, half,
    actual. A rule is safe when it routes no denied case in either half.
    """
    cells = (
        rows.filter("eligible")
        .select(
            passed(F.col("complete"), completes).alias("c"),
            passed(F.col("denial"), denial_max, at_most=True).alias("d"),
            passed(F.col("approval"), approval_min).alias("a"),
            "bio_none",
            "half",
            "actual",
        )
        .filter("c > 0 and d > 0 and a > 0")
        .groupBy("c", "d", "a", "bio_none")
        .agg(
            *[
                F.count_if((F.col("actual") == k) & (F.col("half") == h)).alias(f"{k.lower()}_{h}")
                for k in CLASSES
                for h in (0, 1)
            ]
        )
    )
    points = expand(
        cells,
        {
            "minimum_complete": satisfied(F.col("c"), completes),
            "denial_max": satisfied(F.col("d"), denial_max, at_most=True),
            "approval_min": satisfied(F.col("a"), approval_min),
            "require_bio_none": F.when(F.col("bio_none"), F.array(F.lit(False), F.lit(True))).otherwise(
                F.array(F.lit(False))
            ),
        },
    )
    keys = ["minimum_complete", "denial_max", "approval_min", "require_bio_none"]
    counts = [f"{k.lower()}_{h}" for k in CLASSES for h in (0, 1)]
    summed = points.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])
    grid = full_grid(
        rows, dict(zip(keys, (completes, denial_max, approval_min, (False, True))))
    )
    whole = grid.join(summed, keys, "left").na.fill(0, counts)
    gain = {h: 6 * F.col(f"approved_{h}") - 7 * F.col(f"needs_review_{h}") for h in (0, 1)}
    return whole.select(
        *keys,
        *counts,
        F.least(gain[0], gain[1]).alias("least_gain"),
        (gain[0] + gain[1]).alias("total_gain"),
        ((F.col("denied_0") + F.col("denied_1")) == 0).alias("safe"),
    )


def gain_loss(
    rows: DataFrame,
    *,
    probabilities: Sequence[float],
    margins: Sequence[float],
    scopes: dict[str, Column],
    group: str,
) -> DataFrame:
    """Changed, gains, losses and net per scope, threshold pair and group, with totals.

    ``rows``: current, proposed, actual, probability, margin and the group.
    """
    right, was = F.col("proposed") == F.col("actual"), F.col("current") == F.col("actual")
    changed = rows.filter(F.col("proposed") != F.col("current"))
    cells = (
        changed.select(
            group,
            passed(F.col("probability"), probabilities).alias("p"),
            passed(F.col("margin"), margins).alias("m"),
            F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in scopes.items()])).alias("scopes"),
            right.alias("right"),
            was.alias("was"),
        )
        .filter("p > 0 and m > 0")
        .groupBy(group, "p", "m", "scopes")
        .agg(
            F.count(F.lit(1)).alias("changed"),
            F.count_if(F.col("right") & ~F.col("was")).alias("gains"),
            F.count_if(F.col("was") & ~F.col("right")).alias("losses"),
        )
    )
    points = expand(
        cells,
        {
            "scope": F.col("scopes"),
            "probability": satisfied(F.col("p"), probabilities),
            "min_margin": satisfied(F.col("m"), margins),
        },
    )
    keys = ["scope", "probability", "min_margin"]
    per_group = points.groupBy(*keys, group).agg(
        *[F.sum(c).alias(c) for c in ("changed", "gains", "losses")]
    )
    rolled = per_group.groupingSets([[*keys, group], keys], *keys, group).agg(
        *[F.sum(c).alias(c) for c in ("changed", "gains", "losses")]
    )
    return rolled.withColumns(
        {group: F.coalesce(F.col(group).cast("string"), F.lit("(all)")), "net": F.col("gains") - F.col("losses")}
    )


def crossfit_bins(rows: DataFrame, branch: str, fold: str, bins: int = 5, least_peers: int = 8) -> DataFrame:
    """Correctness of each row's bin estimated from the other folds only.

    A bin is (branch, fifth of approval, fifth of denial); thinner bins fall
    back to the branch. Peer sums are totals minus the own fold, so no row is
    ever paired with another.
    """
    cells = [branch, "a_bin", "d_bin"]
    binned = rows.withColumns(
        {
            "a_bin": F.floor(F.col("approval") * bins).cast("int"),
            "d_bin": F.floor(F.col("denial") * bins).cast("int"),
        }
    )
    own = binned.groupBy(*cells, fold).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("correct").cast("long")).alias("s")
    )

    def others(keys: list[str], prefix: str) -> DataFrame:
        per_fold = own.groupBy(*keys, fold).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        total = per_fold.groupBy(*keys).agg(F.sum("n").alias("tn"), F.sum("s").alias("ts"))
        return per_fold.join(total, keys).select(
            *keys,
            fold,
            (F.col("tn") - F.col("n")).alias(f"{prefix}_n"),
            (F.col("ts") - F.col("s")).alias(f"{prefix}_s"),
        )

    estimate = others(cells, "bin").join(others([branch], "all"), [branch, fold])
    value = F.when(F.col("bin_n") >= least_peers, F.col("bin_s") / F.col("bin_n")).otherwise(
        F.try_divide(F.col("all_s"), F.col("all_n"))
    )
    return binned.join(
        estimate.select(*cells, fold, value.alias("estimate")), [*cells, fold]
    ).drop("a_bin", "d_bin")


def coordinate_thresholds(
    rows: DataFrame,
    flags: tuple[str, ...],
    choices: Sequence[float],
    group: str,
    start: float = 0.65,
    passes: int = 4,
) -> tuple[dict[str, float], dict[str, int]]:
    """Per-flag thresholds by coordinate ascent on (least group net, net, fewer losses, lower).

    ``rows``: current, actual, the group and one probability column ``p_<flag>``.
    Rows are folded once to distinct combinations of threshold levels; each
    step is one aggregation over that table for all choices of one flag.
    """
    ordered = sorted(choices)
    none = F.col("current") == "none"
    folded = (
        rows.filter(none)
        .select(
            group, "actual", *[passed(F.col(f"p_{f}"), ordered).alias(f"l_{f}") for f in flags]
        )
        .groupBy(group, "actual", *[f"l_{f}" for f in flags])
        .agg(F.count(F.lit(1)).alias("n"))
        .persist()
    )
    chosen = {f: start for f in flags}

    def nets(flag: str) -> list[tuple]:
        at_level = {f: F.lit(ordered.index(t)) for f, t in chosen.items() if t in ordered}
        points = folded.withColumn("choice", F.explode(F.sequence(F.lit(0), F.lit(len(ordered) - 1))))

        def on(f: str) -> Column:
            return F.col(f"l_{f}") > (F.col("choice") if f == flag else at_level[f])

        proposed = F.concat_ws("|", *[F.when(on(f), F.lit(f)) for f in sorted(flags)])
        scored = points.withColumn("proposed", proposed).filter(F.col("proposed") != "")
        gain = F.sum(F.when(F.col("proposed") == F.col("actual"), F.col("n")).otherwise(0))
        loss = F.sum(F.when(F.col("actual") == "none", F.col("n")).otherwise(0))
        by_group = scored.groupBy("choice", group).agg(gain.alias("g"), loss.alias("l")).collect()
        groups = sorted({r[group] for r in by_group})
        out = []
        for i, cutoff in enumerate(ordered):
            own = {r[group]: (r["g"], r["l"]) for r in by_group if r["choice"] == i}
            pairs = [own.get(g, (0, 0)) for g in groups] or [(0, 0)]
            gains, losses = sum(g for g, _ in pairs), sum(l for _, l in pairs)
            out.append((min(g - l for g, l in pairs), gains - losses, -losses, -cutoff, cutoff, gains))
        return out

    measured = {"gains": 0, "losses": 0, "net": 0}
    for _ in range(passes):
        moved = False
        for flag in flags:
            best = max(nets(flag))
            measured = {"gains": best[5], "losses": -best[2], "net": best[1]}
            if chosen[flag] != best[4]:
                chosen[flag], moved = best[4], True
        if not moved:
            break
    folded.unpersist()
    return chosen, measured
