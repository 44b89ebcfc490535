from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import ranking, reshape as R, stats as S


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(7)
    n = 6000
    pdf = pd.DataFrame(
        {
            "g": np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b"], n)),
            "x": rng.normal(size=n).round(3),
            "y": rng.integers(0, 6, n).astype(float),
        }
    )
    pdf.loc[::17, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x"))).repartition(6)
    return pdf, df


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_describe_is_exact(wide, accuracy):
    pdf, df = wide
    got = S.describe(df, ["x", "y"], ["g"], accuracy).toPandas().set_index(["g", "variable"])
    for g, part in pdf.groupby("g"):
        for c in ("x", "y"):
            want, row = part[c].describe(), got.loc[(g, c)]
            assert row["count"] == want["count"]
            for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
                assert row[ours] == pytest.approx(want[theirs], abs=1e-9), (g, c, ours)


def test_narrow_brackets_fold_the_rest(wide):
    """With narrow brackets most rows are counted, not gathered."""
    pdf, df = wide
    brackets = S.profile(df, ["x"], [], (0.5,), 100)
    row = brackets.first()
    assert row["lows"][0] <= pdf.x.median() <= row["highs"][0]
    kept = S.ranked_values(df, brackets, ["x"], [], (0.5,)).where("value is not null").agg(F.sum("copies")).first()[0]
    assert kept < 0.2 * len(pdf)


def test_quartiles_interpolate(spark):
    df = spark.createDataFrame([(0.125,), (2.5,), (2.675,)], "v double")
    assert S.describe(df, ["v"]).first()["p25"] == 1.3125
    assert S.describe(df.limit(1), ["v"]).first()["p75"] == 0.125


def test_null_group_is_left_out(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 5.0), ("a", 3.0)], "g string, v double")
    assert [r["g"] for r in S.describe(df, ["v"], ["g"]).collect()] == ["a"]
    shares = R.group_share(df, "g").collect()
    assert [(r["g"], r["count"], r["pct"]) for r in shares] == [("a", 2, 100.0)]


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    row = S.box_stats(df, ["v"], "g").first()
    assert (row["q1"], row["median"], row["q3"]) == (2.25, 3.5, 4.75)
    assert (row["whisker_low"], row["whisker_high"], row["outliers"]) == (1.0, 5.0, 1)


def test_whisker_never_lies_in_the_box(spark):
    df = spark.createDataFrame([("a", v) for v in (0.0, 0.0, 0.0, 10.0)], "g string, v double")
    row = S.box_stats(df, ["v"], "g").first()
    assert (row["q3"], row["whisker_low"], row["whisker_high"], row["outliers"]) == (2.5, 0.0, 2.5, 1)


def test_histogram_lists_empty_bins(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("b", 10.0), (None, 3.0)], "g string, v double")
    got = S.histogram(df, "v", 10, ["g"]).orderBy("g", "bin").collect()
    assert [(r.g, r["count"]) for r in got] == [("a", n) for n in [1, *[0] * 8, 1]] + [("b", n) for n in [*[0] * 9, 1]]


def test_histogram_holds_the_maximum(wide):
    pdf, df = wide
    got = S.histogram(df, "x", 25).toPandas().sort_values("bin")
    counts, edges = np.histogram(pdf.x.dropna(), bins=25)
    assert got["count"].sum() == counts.sum() and got["bin"].max() == 24
    assert got.set_index("bin")["count"].reindex(range(25), fill_value=0).tolist() == counts.tolist()
    assert (got["density"] * (edges[1] - edges[0])).sum() == pytest.approx(1.0)


def test_density_curve_follows_the_kernel_sum(wide):
    pdf, df = wide
    curve = S.density_curve(df, "x", points=50, share_of_all=False).toPandas().sort_values("point")
    x = pdf.x.dropna().to_numpy()
    bw = x.std(ddof=1) * len(x) ** -0.2
    want = [np.exp(-0.5 * ((p - x) / bw) ** 2).mean() / (bw * np.sqrt(2 * np.pi)) for p in curve.x]
    assert np.allclose(curve.density, want, atol=2e-4)
    by_group = S.density_curve(df, "x", ["g"], points=200).toPandas()
    area = sum(np.trapezoid(p.sort_values("point").density, p.sort_values("point").x) for _, p in by_group.groupby("g"))
    assert area == pytest.approx(1.0, abs=0.01)


def test_correlations_skip_nulls_pairwise(wide):
    pdf, df = wide
    assert S.correlations(df, ["x", "y"]).first()["corr"] == pytest.approx(pdf[["x", "y"]].corr().iloc[0, 1])


def test_equal_correlations_keep_column_order(spark):
    df = spark.createDataFrame([(1.0, 2.0, 4.0), (2.0, 4.0, 8.0), (3.0, 6.0, 12.0)], "c double, b double, a double")
    top = S.top_correlations(df, ["c", "b", "a"], 2).collect()
    assert [(r.var1, r.var2) for r in top] == [("c", "b"), ("c", "a")]


def test_compare_groups(spark):
    df = spark.createDataFrame([(0, 2.0), (0, 2.0), (1, 3.0)], "f int, v double")
    row = S.compare_groups(df, ["v"], "f").first()
    assert (row.mean_active, row.mean_churned, row.diff_pct) == (2.0, 3.0, 50.0)


@pytest.mark.parametrize("max_rows", [10, 20_000])
def test_running_totals_across_ranges(spark, max_rows):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b"], 500), "o": rng.permutation(500), "v": rng.integers(0, 9, 500)})
    df = spark.createDataFrame(pdf).repartition(5)
    got = ranking.running_totals(df, ["o"], {"total": "v"}, ["k"], max_rows).toPandas()
    pdf = pdf.sort_values("o")
    pdf["total"] = pdf.groupby("k").v.cumsum()
    merged = got.merge(pdf, on=["k", "o"])
    assert len(merged) == 500 and (merged.total_x == merged.total_y).all()
    numbered = ranking.number_rows(df, ["o"], "n", max_rows).orderBy("o").toPandas()
    assert numbered.n.tolist() == list(range(1, 501))


def test_average_rank_shares_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0)], "i int, v double")
    got = {r.i: r["rank"] for r in df.withColumn("rank", ranking.average_rank("v")).collect()}
    assert got == {1: 2.5, 2: 2.5, 3: 1.0}


def test_winner_breaks_ties(spark):
    df = spark.createDataFrame([(2, 5.0), (1, 5.0), (3, None)], "i int, v double")
    assert ranking.winner(df, "v", "i").first().i == 1
    assert ranking.winner(df, "v", "i", largest=False).first().i == 1


def test_reshape(spark):
    df = spark.createDataFrame([("s", "hi"), ("s", "lo"), ("s", "lo"), ("t", "lo"), (None, "lo"), ("t", None)], "a string, b string")
    counts = {r.a: (r.hi, r.mid, r.lo) for r in R.crosstab(df, "a", "b", ["hi", "mid", "lo"]).collect()}
    assert counts == {"s": (1, 0, 2), "t": (0, 0, 1)}
    pct = R.crosstab_percent(df, "a", "b", ["hi", "mid", "lo"]).collect()
    assert all(r.hi + r.mid + r.lo == pytest.approx(100) for r in pct)
    again = R.reindex(R.group_count(df, "a"), "a", ["t", "u", "s"]).orderBy("position").collect()
    assert [(r.a, r["count"]) for r in again] == [("t", 2), ("u", None), ("s", 3)]
    flat = spark.createDataFrame([(1, 2.0), (2, 2.0)], "i int, v double")
    assert [r.v for r in R.minmax_scale(flat, ["v"]).collect()] == [None, None]
