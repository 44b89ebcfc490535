"""Descriptive statistics: exact quantiles, describe, correlation, histograms, density, boxes."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.config import settle
from tallyhouse.operators.ranking import running_totals

QUARTILES = (0.25, 0.5, 0.75)


def _unpivoted(df: DataFrame, columns: Sequence[str], groups: Sequence[str]) -> DataFrame:
    """One row per group row and measured column: ``variable``, ``value``; nulls dropped."""
    cells = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(*groups, F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def profile(
    df: DataFrame,
    columns: Sequence[str],
    groups: Sequence[str] = (),
    probabilities: Sequence[float] = QUARTILES,
    accuracy: int = 10_000,
) -> DataFrame:
    """Count, mean, deviation, range and quantile brackets per group and column.

    One pass over the rows. ``lows[i]`` and ``highs[i]`` enclose the exact quantile
    ``i``: input partitions are dealt to a few salts, each salt has a mergeable sketch
    whose rank error is at most 1/accuracy of its rows, and a quantile of the whole lies
    between the smallest and the largest of the salts' own brackets, which are two such
    errors wide on either side. So no task merges the sketches of all partitions. Below
    the row count where these errors exceed the rounding of ranks, the bracket is the
    whole range.
    """
    margin = 2.0 / accuracy
    marks = [max(0.0, p - margin) for p in probabilities] + [min(1.0, p + margin) for p in probabilities]
    size = len(probabilities)
    measured = []
    for c in columns:
        x = F.col(c).cast("double")
        measured.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.count(x).alias("n"),
                F.avg(x).alias("mean"),
                (F.var_pop(x) * F.count(x)).alias("squares"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
                F.percentile_approx(x, marks, accuracy).alias("marks"),
            ).alias(f"m_{c}")
        )
    present = df
    for g in groups:
        present = present.where(F.col(g).isNotNull())
    # Partition p goes to salt floor(sqrt(p)): of P partitions at most about 2 sqrt(P) meet in one task.
    salted = present.withColumn("_salt", F.floor(F.sqrt(F.spark_partition_id())))
    per_salt = salted.groupBy(*groups, "_salt").agg(*measured)
    parts = settle(per_salt.select(*groups, F.inline(F.array(*[F.col(f"m_{c}") for c in columns]))))
    keys = [*groups, "variable"]
    mean = F.sum(F.col("n") * F.col("mean")).over(Window.partitionBy(*keys)) / F.sum("n").over(
        Window.partitionBy(*keys)
    )
    merged = (
        parts.withColumn("centre", F.when(F.col("n") > 0, mean))
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.max("centre").alias("mean"),
            F.sum(F.col("squares") + F.col("n") * F.pow(F.col("mean") - F.col("centre"), 2)).alias("squares"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
            F.count(F.lit(1)).alias("salts"),
            F.array(*[F.min(F.col("marks")[i]) for i in range(size)]).alias("lows"),
            F.array(*[F.max(F.col("marks")[size + i]) for i in range(size)]).alias("highs"),
        )
    )
    whole = F.col("n") <= accuracy * (F.col("salts") + 3)
    return merged.select(
        *keys,
        "n",
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1))).alias("std"),
        "min",
        "max",
        F.when(whole, F.array_repeat("min", size)).otherwise(F.col("lows")).alias("lows"),
        F.when(whole, F.array_repeat("max", size)).otherwise(F.col("highs")).alias("highs"),
    )


def ranked_values(
    df: DataFrame,
    brackets: DataFrame,
    columns: Sequence[str],
    groups: Sequence[str] = (),
    probabilities: Sequence[float] = QUARTILES,
) -> DataFrame:
    """Distinct values near each quantile with the exact number of rows up to them.

    Rows outside every bracket are only counted, and map-side aggregation folds them
    to one row per task, so neither a hot group nor a wide column is ever gathered;
    the values inside the brackets are summed up range by range.
    Columns: groups, variable, value, copies, upto, n.
    """
    keys = [*groups, "variable"]
    size = range(len(probabilities))
    value = F.col("value")
    inside = F.lit(False)
    slot = F.lit(0)
    for i in size:
        low, high = F.col("lows")[i], F.col("highs")[i]
        inside = inside | ((value >= low) & (value <= high))
        slot = slot + (value > high).cast("int")
    counted = (
        _unpivoted(df, columns, groups)
        .join(brackets.select(*keys, "n", "lows", "highs"), keys)
        .groupBy(*keys, "n", slot.alias("slot"), F.when(inside, value).alias("value"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    summed = running_totals(counted, ["slot", "value"], {"upto": "copies"}, keys)
    return summed.select(*keys, "value", "copies", "upto", "n")


def value_at_rank(rank: Column) -> Column:
    """Aggregate over ``ranked_values``: the value that holds the given 1-based rank."""
    hit = F.col("value").isNotNull() & (F.col("upto") - F.col("copies") < rank) & (F.col("upto") >= rank)
    return F.max(F.when(hit, F.col("value")))


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    groups: Sequence[str] = (),
    probabilities: Sequence[float] = QUARTILES,
    accuracy: int = 10_000,
    brackets: DataFrame | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles ``q0, q1, ...`` per group and column."""
    keys = [*groups, "variable"]
    if brackets is None:
        brackets = settle(profile(df, columns, groups, probabilities, accuracy))
    ranked = ranked_values(df, brackets, columns, groups, probabilities)
    picks = []
    for i, p in enumerate(probabilities):
        place = F.lit(p) * (F.col("n") - 1)
        picks.append(value_at_rank(F.floor(place) + 1).alias(f"a{i}"))
        picks.append(value_at_rank(F.ceil(place) + 1).alias(f"b{i}"))
    found = ranked.groupBy(*keys, "n").agg(*picks)
    missed = F.raise_error(F.lit("a quantile lies outside its bracket; raise the accuracy")).cast("double")
    out = []
    for i, p in enumerate(probabilities):
        place = F.lit(p) * (F.col("n") - 1)
        low = F.coalesce(F.col(f"a{i}"), missed)
        high = F.coalesce(F.col(f"b{i}"), missed)
        out.append((low + (high - low) * (place - F.floor(place))).alias(f"q{i}"))
    return found.select(*keys, *out)


def describe(
    df: DataFrame, columns: Sequence[str], groups: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """count, mean, std, min, p25, p50, p75, max per group and column."""
    keys = [*groups, "variable"]
    brackets = settle(profile(df, columns, groups, QUARTILES, accuracy))
    middle = quantiles(df, columns, groups, QUARTILES, accuracy, brackets)
    return brackets.join(middle, keys).select(
        *keys,
        F.col("n").alias("count"),
        "mean",
        "std",
        "min",
        F.col("q0").alias("p25"),
        F.col("q1").alias("p50"),
        F.col("q2").alias("p75"),
        "max",
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r for each pair i < j: ``var1, var2, corr``, pairs with a null skipped.

    Without nulls one pass gives the means and one the sums of centred products, few
    enough for generated code; with nulls each pair has its own rows and is measured alone.
    """
    pairs = list(combinations(columns, 2))
    x = {c: F.col(c).cast("double") for c in columns}
    first = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(x[c]).alias(f"n_{c}") for c in columns],
        *[F.avg(x[c]).alias(f"m_{c}") for c in columns],
    ).first()
    if first["rows"] and all(first[f"n_{c}"] == first["rows"] for c in columns):
        centred = df.select(*[(x[c] - F.lit(first[f"m_{c}"])).alias(c) for c in columns])
        sums = centred.agg(
            *[F.sum(F.col(c) * F.col(c)).alias(f"s_{c}") for c in columns],
            *[F.sum(F.col(a) * F.col(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)],
        )
        one_row = sums.select(
            *[
                F.try_divide(F.col(f"r{i}"), F.sqrt(F.col(f"s_{a}")) * F.sqrt(F.col(f"s_{b}"))).alias(f"r{i}")
                for i, (a, b) in enumerate(pairs)
            ]
        )
    else:
        one_row = df.agg(*[F.corr(x[a], x[b]).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"r{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return one_row.select(F.inline(F.array(*cells)))


def top_correlations(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The k strongest pairs by absolute value; equal ones in column order."""
    position = F.array(*[F.lit(c) for c in columns])
    return (
        correlations(df, columns)
        .withColumn("abs_corr", F.abs("corr"))
        .orderBy(
            F.desc_nulls_last("abs_corr"),
            F.array_position(position, F.col("var1")),
            F.array_position(position, F.col("var2")),
        )
        .limit(k)
    )


def _limits(df: DataFrame, column: str, groups: Sequence[str] = ()) -> DataFrame:
    x = F.col(column).cast("double")
    return settle(
        df.where(x.isNotNull())
        .groupBy(*groups)
        .agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"), F.stddev_samp(x).alias("std"))
    )


def _with_limits(values: DataFrame, limits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the limits of each group; without groups the one row becomes literals."""
    if keys:
        return values.join(limits, list(keys))
    row = limits.first()
    return values.select("*", *[F.lit(row[c] if row else None).cast("double").alias(c) for c in limits.columns])


def _cell(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width cell; the maximum belongs to the last one."""
    width = (high - low) / F.lit(float(bins))
    near = F.least(F.floor((value - low) / width), F.lit(bins - 1))
    # A quotient at an edge may round to the wrong side: settle it by the edges themselves.
    exact = (
        F.when(value < low + near * width, near - 1)
        .when((value >= low + (near + 1) * width) & (near < bins - 1), near + 1)
        .otherwise(near)
    )
    return F.when(high > low, exact).otherwise(0)


def histogram(
    df: DataFrame, column: str, bins: int, groups: Sequence[str] = (), per_group_range: bool = False
) -> DataFrame:
    """Equal-width counts and densities: ``bin, lower, upper, count, density``.

    The range is that of the whole column, or of each group when asked. Every bin is
    listed, empty ones with count 0; a column of one value has all rows in the first bin.
    """
    x = F.col(column).cast("double")
    present = df.where(x.isNotNull())
    for g in groups:
        present = present.where(F.col(g).isNotNull())
    keys = list(groups) if per_group_range else []
    limits = _limits(present, column, keys)
    values = present.select(*groups, x.alias("value"))
    bounded = _with_limits(values, limits.select(*keys, "lo", "hi"), keys)
    counted = bounded.groupBy(
        *groups, "lo", "hi", _cell(F.col("value"), F.col("lo"), F.col("hi"), bins).cast("int").alias("bin")
    ).agg(F.count(F.lit(1)).alias("count"))
    every = counted.select(*groups, "lo", "hi").distinct()
    every = every.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    keys_of_bin = [*groups, "bin"]
    counted = every.join(counted.select(*keys_of_bin, "count"), keys_of_bin, "left").fillna(0, ["count"])
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    total = F.sum("count").over(Window.partitionBy(*groups))
    return counted.select(
        *groups,
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        "count",
        F.try_divide(F.col("count").cast("double"), total * width).alias("density"),
    )


def histograms(df: DataFrame, columns: Sequence[str], bins: int, groups: Sequence[str] = ()) -> DataFrame:
    """``histogram`` of several columns in one pass, each column and group over its own range: adds ``variable``."""
    return histogram(_unpivoted(df, columns, groups), "value", bins, [*groups, "variable"], per_group_range=True)


def density_curves(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """``density_curve`` of several columns in one pass: adds ``variable``.

    The curves of the groups of one column integrate to one together.
    """
    return density_curve(_unpivoted(df, columns, groups), "value", [*groups, "variable"], shared=["variable"])


def density_curve(
    df: DataFrame,
    column: str,
    groups: Sequence[str] = (),
    points: int = 200,
    cells: int = 2048,
    cut: float = 3.0,
    share_of_all: bool = True,
    shared: Sequence[str] = (),
) -> DataFrame:
    """Gaussian kernel density per group on an even grid: ``point, x, density``.

    Scott bandwidth. Rows are first counted into ``cells`` equal-width cells per group,
    so the kernels are summed over at most ``cells * points`` terms per group whatever
    the number of rows. With ``share_of_all`` the curves of all groups (that agree in
    ``shared``) integrate to one together, otherwise each does.
    """
    keys = list(groups)
    x = F.col(column).cast("double")
    limits = _limits(df, column, keys)
    for g in keys:
        limits = limits.where(F.col(g).isNotNull())
    everyone = Window.partitionBy(*(shared or [F.lit(0)]))
    limits = limits.select(
        *keys,
        "lo",
        "hi",
        (F.sum("n").over(everyone) if share_of_all else F.col("n")).cast("double").alias("weight"),
        (F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("bw"),
    ).where("bw > 0")
    values = _with_limits(df.where(x.isNotNull()).select(*keys, x.alias("value")), limits, keys)
    counted = (
        values.groupBy(
            *keys,
            "lo",
            "hi",
            "weight",
            "bw",
            _cell(F.col("value"), F.col("lo"), F.col("hi"), cells).alias("cell"),
        )
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("center", F.col("lo") + (F.col("cell") + 0.5) * (F.col("hi") - F.col("lo")) / F.lit(float(cells)))
    )
    step = (F.col("hi") - F.col("lo") + 2 * cut * F.col("bw")) / F.lit(float(points - 1))
    at = F.col("lo") - cut * F.col("bw") + F.col("point") * step
    z = (F.col("x") - F.col("center")) / F.col("bw")
    kernel = F.exp(-0.5 * z * z) / (F.col("bw") * F.lit(2.5066282746310002) * F.col("weight"))
    return (
        counted.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", at)
        .groupBy(*keys, "point", "x")
        .agg(F.sum(F.col("copies") * kernel).alias("density"))
    )


def box_stats(df: DataFrame, columns: Sequence[str], group: str, accuracy: int = 10_000) -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges, and outlier count per group.

    A whisker ends at the box where no value lies between the box and its reach.
    """
    keys = [group, "variable"]
    present = df.where(F.col(group).isNotNull())
    boxes = settle(quantiles(present, columns, [group], QUARTILES, accuracy))
    reach = 1.5 * (F.col("q2") - F.col("q0"))
    within = (F.col("value") >= F.col("q0") - reach) & (F.col("value") <= F.col("q2") + reach)
    return (
        _unpivoted(present, columns, [group])
        .join(boxes, keys)
        .groupBy(*keys, "q0", "q1", "q2")
        .agg(
            F.least(F.min(F.when(within, F.col("value"))), F.col("q0")).alias("whisker_low"),
            F.greatest(F.max(F.when(within, F.col("value"))), F.col("q2")).alias("whisker_high"),
            F.count_if(~within).alias("outliers"),
        )
        .select(
            *keys,
            F.col("q0").alias("q1"),
            F.col("q1").alias("median"),
            F.col("q2").alias("q3"),
            "whisker_low",
            "whisker_high",
            "outliers",
        )
    )


def compare_groups(df: DataFrame, columns: Sequence[str], flag: str) -> DataFrame:
    """Means of rows with flag 0 and flag 1 and the difference in percent of the former.

    Means are rounded to three places before the difference is taken.
    """
    wide = df.agg(
        *[
            F.avg(F.when(F.col(flag) == side, F.col(c))).alias(f"{c}|{side}")
            for c in columns
            for side in (0, 1)
        ]
    )
    cells = [
        F.struct(
            F.lit(c).alias("variable"),
            F.bround(F.col(f"`{c}|0`"), 3).alias("mean_active"),
            F.bround(F.col(f"`{c}|1`"), 3).alias("mean_churned"),
        )
        for c in columns
    ]
    long = wide.select(F.inline(F.array(*cells)))
    change = F.try_divide(F.col("mean_churned") - F.col("mean_active"), F.col("mean_active")) * 100
    return long.withColumn("diff_pct", F.bround(change, 1))
