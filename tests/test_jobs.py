from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.config import RunConfig, settle, shared_dir
from tallyhouse.operators import quality as Q, risk as K, warehouse as W
from tallyhouse.plans import jobs
from tallyhouse.sources import sinks
from tallyhouse.sources.tables import list_catalog, require, scan_csv


@pytest.fixture(scope="module")
def cfg(tmp_path_factory):
    """Small files with a planted churn signal, one unreadable date and one unmatched customer."""
    folder = tmp_path_factory.mktemp("run")
    draw = random.Random(9)
    names = schemas.CSV_FEATURES.fieldNames()
    features, targets = [",".join(names)], ["Customer_ID,churned"]
    for i in range(240):
        gone = draw.random() < 0.25
        days = draw.randint(150, 300) if gone else draw.randint(1, 90)
        engagement = draw.uniform(0, 4) if gone else draw.uniform(4, 10)
        row = [f"C{i:04d}", draw.choice(["Yes", "No"]), draw.randint(1, 80), draw.randint(1, 40), days]
        row += [round(draw.uniform(10, 300), 2)] + [round(draw.random(), 3) for _ in range(5)]
        row += [draw.randint(0, 9), round(draw.uniform(1, 5), 2), round(engagement, 2), round(draw.uniform(1, 10), 2)]
        features.append(",".join(map(str, row)))
        if i != 7:
            targets.append(f"C{i:04d},{'Yes' if gone else 'No'}")
    orders = [",".join(schemas.CSV_ORDERS.fieldNames())]
    for i in range(300):
        day = "soon" if i == 5 else f"2018-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d}"
        orders.append(
            f"{i},{day},{draw.choice(['Toys', 'Books'])},{draw.choice(['Card', 'Cash'])},"
            f"{draw.choice(['Delivered', 'Returned'])},{draw.randint(18, 80)},{draw.uniform(5, 500):.2f},"
            f"{draw.randint(1, 20)},{draw.randint(1, 5)},{draw.choice(['Yes', 'No'])}"
        )
    for name, lines in (("features", features), ("targets", targets), ("orders", orders)):
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return RunConfig(
        *[str(folder / f"{n}.csv") for n in ("features", "targets", "orders")],
        warehouse=str(folder / "warehouse"),
        expected_rows=(("fact_customers", 239), ("fact_orders", 299), ("dim_loyalty_status", 2)),
    )


def test_whole_run(spark, cfg):
    with pytest.raises(FileNotFoundError):
        jobs.validate(spark, cfg)
    jobs.create_warehouse(spark, cfg)
    assert jobs.read(spark, cfg, "dim_date").schema.fieldNames() == schemas.DIM_DATE.fieldNames()
    assert jobs.read(spark, cfg, "fact_orders").count() == 0
    assert {r.target: r.rows_written for r in jobs.load_customers(spark, cfg).collect()} == {
        "fact_customers": 239, "rejected_customers": 0,
    }
    report = {r.target: r.rows_written for r in jobs.load_orders(spark, cfg).collect()}
    assert report["fact_orders"] == 299 and report["rejected_orders"] == 1
    checks = jobs.validate(spark, cfg).collect()
    assert len(checks) > 60 and all(c.passed for c in checks)

    jobs.load_orders(spark, cfg)  # a repeat changes nothing
    assert jobs.read(spark, cfg, "dim_product_category").count() == 2
    assert jobs.read(spark, cfg, "fact_orders").count() == 299

    jobs.register_views(spark, cfg)
    assert spark.table("vw_orders_full").count() == 299
    assert {r[0] for r in spark.table("vw_customers_full").select("churned").distinct().collect()} == {"Yes", "No"}
    listed = {(r.type, r.name) for r in list_catalog(spark).collect()}
    assert {("view", "vw_orders_full"), ("view", "vw_customers_full")} <= listed

    profile = jobs.segment_customers(spark, cfg, restarts=2)
    assert profile.agg(F.sum("customers")).first()[0] == 239 and profile.count() == 4

    compared = {r.metric: r for r in jobs.score_churn(spark, cfg, rounds=5).collect()}
    assert compared["roc_auc"].first_value > 0.95 and compared["roc_auc"].second_value > 0.95
    scores = jobs.read(spark, cfg, "churn_scores")
    assert scores.count() == 239 and scores.where("risk_tier = 'Crítico'").count() > 0

    reports = jobs.risk_reports(spark, cfg)
    summary = reports["summary"].first()
    assert summary.customers == 239 and summary.riskiest == "at_risk"
    assert reports["percent"].count() == 4
    split = reports["recoverable"].first()
    assert split.critical == split.lost + split.recoverable == summary.critical
    assert reports["map"].count() == 239
    assert all(v.count() > 0 for v in reports.values())


def test_csv_cells(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("Customer_ID,churned\nA,Yes\nB,NA\nC,\n")
    assert [tuple(r) for r in scan_csv(spark, str(path), schemas.CSV_TARGETS).collect()] == [
        ("A", "Yes"), ("B", None), ("C", None),
    ]
    numbers = tmp_path / "n.csv"
    numbers.write_text("a,b\n1,x\n,2.5\nnull,3\n")
    schema = schemas.struct("a int, b double")
    rows = scan_csv(spark, str(numbers), schema, bad_rows="bad").collect()
    assert [tuple(r) for r in rows] == [(1, None, "b"), (None, 2.5, ""), (None, 3.0, "")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    path = str(tmp_path / "t")
    sinks.append(df, path)
    sinks.append(df, path)
    assert spark.read.parquet(path).count() == 4
    sinks.overwrite(df, path)
    assert spark.read.parquet(path).count() == 2
    parts = str(tmp_path / "p")
    sinks.overwrite(df, parts, ["p"])
    changed = spark.createDataFrame([(9, "b")], df.schema)
    sinks.overwrite(changed, parts, ["p"], only_present=True)
    assert sorted(r.k for r in spark.read.parquet(parts).collect()) == [1, 9]
    sinks.overwrite(changed, parts, ["p"])
    assert [r.k for r in spark.read.parquet(parts).collect()] == [9]
    assert sinks.write_counted(df, str(tmp_path / "c")) == 2
    fresh = sinks.new_keys(spark.createDataFrame([(2,), (3,), (3,)], "k int"), df, ["k"])
    assert [r.k for r in fresh.collect()] == [3]


def test_declared_tables(spark):
    for name, schema in schemas.WAREHOUSE.items():
        sinks.create_table(spark, f"declared_{name}", schema)
        assert spark.table(f"declared_{name}").columns == schema.fieldNames()
        spark.sql(f"DROP TABLE declared_{name}")


def test_orphans_count_null_and_unknown(spark):
    fact = spark.createDataFrame([(1,), (1,), (9,), (None,)], "fk int")
    dim = spark.createDataFrame([(1,), (2,)], "pk int")
    assert Q.orphans([("r", fact, "fk", dim, "pk")]).first().broken == 2


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, 0), (1, 2), (2, None), (None, 1), (None, 1)], "k int, f int")
    assert tuple(Q.duplicates(df, "t", ["k"]).first())[2:] == (1, 1)
    assert {r.column: r.nulls for r in Q.nulls(df, "t", ["k", "f"]).collect()} == {"k": 2, "f": 1}
    assert Q.domain_violations(df, "t", {"flag": "f IN (0, 1)"}).first().violations == 1
    counts = {r.table: r.status for r in Q.row_counts({"a": df, "b": df, "c": df}, {"a": 5, "b": 4}).collect()}
    assert counts == {"a": "ok", "b": "fail", "c": "info"}
    passed = spark.createDataFrame([(True,), (False,)], "passed boolean")
    assert tuple(Q.verdict([passed]).first()) == (2, 1, False)


@pytest.mark.parametrize("max_rows", [1, 20_000])
def test_lookup_keys_follow_first_appearance(spark, max_rows):
    df = spark.createDataFrame([(3, "b"), (1, "c"), (2, "b"), (4, "a"), (5, None)], "i int, n string")
    dim = W.lookup_dimensions(df, ["n"], "i", max_rows)["n"]
    assert [(r.key, r.name) for r in dim.orderBy("key").collect()] == [(1, "c"), (2, "b"), (3, "a")]
    mapped = W.map_lookup(spark.createDataFrame([("a",), ("z",), (None,)], "n string"), "n", dim, "id")
    assert [(r.n, r.id) for r in mapped.collect()] == [("a", 3), ("z", None), (None, None)]


def test_critical_report_with_missing_tier(spark):
    rows = [("loyal", "low", 0.1, 0), ("at_risk", "critical", 0.9, 1), ("at_risk", "critical", 0.8, 1), ("loyal", None, 0.0, 0)]
    df = spark.createDataFrame(rows, "segment string, risk_tier string, churn_score double, churned int")
    df = df.select("*", F.lit(1).alias("days_since_last_purchase"), F.lit(2.0).alias("avg_order_value"), F.lit(3.0).alias("engagement_score"))
    critical = K.critical_by_segment(df)
    row = critical.collect()
    assert [(r.segment, r.customers, r.pct_of_all, r.pct_of_segment) for r in row] == [("at_risk", 2, 50.0, 100.0)]
    assert tuple(K.hotspot(critical).first()) == ("at_risk", 100.0, 0)
    assert tuple(K.recoverable_or_lost(critical).first()) == (2, 2, 0)
    summary = K.executive_summary(df).first()
    assert (summary.customers, summary.critical, summary.recoverable, summary.healthiest, summary.riskiest) == (4, 2, 0, "loyal", "at_risk")


def test_settle_keeps_content_and_types(spark):
    df = spark.range(50).select("id", (F.col("id") % 3).cast("int").alias("k"), F.lit("2020-01-01").cast("date").alias("d"))
    for limit in (10, 100):
        fixed = settle(df, limit)
        assert fixed.schema.simpleString() == df.schema.simpleString() and fixed.count() == 50
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    with pytest.raises(FileNotFoundError):
        require(spark, "/no/such/input")
