"""Batch jobs: CSV files to warehouse tables, validation, segmentation, scoring, risk reports.

Each job checks its inputs, reads stored tables and replaces its own output, so a job
can be repeated after a failure.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import schemas
from tallyhouse.config import RunConfig, local_frame, stored
from tallyhouse.functions import expressions as X
from tallyhouse.labels import SEGMENT_FEATURES, SEGMENT_NAMES, TIER_NAMES, TIER_ORDER
from tallyhouse.operators import classify as C, evaluate as E, quality as Q, reshape as R, risk as K, segments as G
from tallyhouse.operators import newton as N, warehouse as W
from tallyhouse.operators.models import load_model, save_model
from tallyhouse.operators.ranking import number_rows
from tallyhouse.sources import sinks, versions
from tallyhouse.sources.tables import require, scan_csv


# Tables that are replaced whole while others read them.
VERSIONED = ("customer_segments", "churn_scores")


def read(spark: SparkSession, cfg: RunConfig, name: str) -> DataFrame:
    require(spark, cfg.table(name))
    if name in VERSIONED:
        return versions.current(spark, cfg.table(name), schemas.WAREHOUSE[name])
    return spark.read.schema(schemas.WAREHOUSE[name]).parquet(cfg.table(name))


def create_warehouse(spark: SparkSession, cfg: RunConfig) -> None:
    """Replace every warehouse table by an empty one with its declared columns."""
    for name, schema in schemas.WAREHOUSE.items():
        write = versions.replace if name in VERSIONED else sinks.overwrite
        write(local_frame(spark, [], schema), cfg.table(name))


def _stored(spark: SparkSession, path: str) -> bool:
    try:
        require(spark, path)
    except FileNotFoundError:
        return False
    return True


def upsert_names(spark: SparkSession, path: str, incoming: DataFrame, key: str, name: str) -> DataFrame:
    """Append names that are not stored yet, numbered after the largest stored key."""
    if not _stored(spark, path):
        incoming.write.parquet(path)
    else:
        stored = spark.read.parquet(path)
        top = stored.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
        fresh = sinks.new_keys(incoming, stored, [name])
        numbered = number_rows(fresh, [key], "_number").withColumn(key, (F.col("_number") + F.lit(top)).cast("int"))
        sinks.append(numbered.select(incoming.columns), path)
    return spark.read.parquet(path)


def _report(spark: SparkSession, rows: list[tuple[str, int]]) -> DataFrame:
    return spark.createDataFrame(rows, "target string, rows_written bigint")


def load_customers(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Join the two customer files, write the loyalty dimension, facts and rejects."""
    require(spark, cfg.features_csv, cfg.targets_csv)
    features = scan_csv(spark, cfg.features_csv, schemas.CSV_FEATURES)
    targets = scan_csv(spark, cfg.targets_csv, schemas.CSV_TARGETS)
    joined = (
        features.join(targets, "Customer_ID", "inner")
        .withColumnsRenamed({"Customer_ID": "customer_id", "loyalty_member": "loyalty_status"})
        .withColumn("churned", X.flag_from_text(F.col("churned")))
    )
    loyalty = upsert_names(
        spark,
        cfg.table("dim_loyalty_status"),
        W.loyalty_dimension(spark),
        "loyalty_status_id",
        "status_name",
    )
    good, bad = W.split_rejects(W.customer_facts(joined, loyalty), schemas.FACT_CUSTOMERS.fieldNames())
    return _report(
        spark,
        [
            ("fact_customers", sinks.write_counted(good, cfg.table("fact_customers"))),
            ("rejected_customers", sinks.write_counted(bad, cfg.table("rejected_customers"))),
        ],
    )


def load_orders(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Write the three lookups, the date dimension, order facts and rejects."""
    require(spark, cfg.orders_csv)
    orders = scan_csv(spark, cfg.orders_csv, schemas.CSV_ORDERS)
    orders = orders.withColumn("order_date", F.col("order_date").try_cast("date")).withColumn(
        "discount_applied", X.flag_from_text(F.col("discount_applied"))
    )
    incoming = W.lookup_dimensions(orders, list(W.ORDER_LOOKUPS), "order_id")
    lookups = {}
    for column, (target, key, name) in W.ORDER_LOOKUPS.items():
        named = incoming[column].select(F.col("key").alias(key), F.col("name").alias(name))
        stored = upsert_names(spark, cfg.table(target), named, key, name)
        lookups[column] = stored.select(F.col(key).alias("key"), F.col(name).alias("name"))
    dates = sinks.write_counted(W.date_dimension(orders, "order_date"), cfg.table("dim_date"))
    good, bad = W.split_rejects(W.order_facts(orders, lookups), schemas.FACT_ORDERS.fieldNames())
    return _report(
        spark,
        [
            ("dim_date", dates),
            ("fact_orders", sinks.write_counted(good, cfg.table("fact_orders"))),
            ("rejected_orders", sinks.write_counted(bad, cfg.table("rejected_orders"))),
        ],
    )


def register_views(spark: SparkSession, cfg: RunConfig) -> None:
    """Publish the two label views under their names in the session catalog."""
    customers = W.customers_view(read(spark, cfg, "fact_customers"), read(spark, cfg, "dim_loyalty_status"))
    customers.createOrReplaceTempView("vw_customers_full")
    dims = {
        column: read(spark, cfg, target).select(F.col(key).alias("key"), F.col(name).alias("name"))
        for column, (target, key, name) in W.ORDER_LOOKUPS.items()
    }
    orders = W.orders_view(read(spark, cfg, "fact_orders"), read(spark, cfg, "dim_date"), dims)
    orders.createOrReplaceTempView("vw_orders_full")


def validate(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """``check, subject, value, passed`` of every declared rule over the stored tables."""
    tables = {name: read(spark, cfg, name) for name in schemas.UNIQUE_KEYS}
    expected = {name: dict(cfg.expected_rows).get(name) for name in tables}
    none = F.col("value") == 0
    parts = [
        Q.row_counts(tables, expected).select(
            F.lit("rows").alias("check"),
            F.col("table").alias("subject"),
            F.col("rows").alias("value"),
            (F.col("status") != "fail").alias("passed"),
        ),
        Q.orphans(
            [(f"{fact}.{fk}", tables[fact], fk, tables[dim], pk) for fact, fk, dim, pk in schemas.FOREIGN_KEYS]
        ).select(F.lit("orphans").alias("check"), F.col("relation").alias("subject"), F.col("broken").alias("value")),
    ]
    for name, frame in tables.items():
        required = [f.name for f in schemas.WAREHOUSE[name].fields if not f.nullable]
        parts.append(
            Q.nulls(frame, name, required).select(
                F.lit("nulls").alias("check"),
                F.concat_ws(".", "table", "column").alias("subject"),
                F.col("nulls").alias("value"),
            )
        )
        for key in schemas.UNIQUE_KEYS[name]:
            parts.append(
                Q.duplicates(frame, name, key).select(
                    F.lit("unique").alias("check"),
                    F.concat_ws(".", "table", "key").alias("subject"),
                    F.col("duplicate_keys").alias("value"),
                )
            )
    for name, rules in schemas.DOMAIN_RULES.items():
        parts.append(
            Q.domain_violations(tables[name], name, rules).select(
                F.lit("domain").alias("check"),
                F.concat_ws(".", "table", "rule").alias("subject"),
                F.col("violations").alias("value"),
            )
        )
    return reduce(
        DataFrame.unionByName, [p if "passed" in p.columns else p.withColumn("passed", none) for p in parts]
    )


def segment_customers(spark: SparkSession, cfg: RunConfig, k: int = 4, restarts: int = 10) -> DataFrame:
    """Cluster, name and store the segments; returns their profile."""
    facts = read(spark, cfg, "fact_customers")
    loyalty = read(spark, cfg, "dim_loyalty_status").select(
        "loyalty_status_id", F.col("status_name").alias("loyalty_status")
    )
    clustered = G.assign_clusters(facts, SEGMENT_FEATURES, k, cfg.seed, restarts)
    codes = {r["cluster"]: r["segment"] for r in G.name_segments(G.cluster_means(clustered)).collect()}
    named = clustered.withColumn("segment", X.rename_values(F.col("cluster"), codes))
    assigned = named.select(
        "customer_id",
        F.col("cluster").alias("cluster_id"),
        X.rename_values(F.col("segment"), SEGMENT_NAMES).alias("segment_name"),
    )
    versions.replace(assigned, cfg.table("customer_segments"))
    kept = read(spark, cfg, "customer_segments")
    whole = facts.join(kept, "customer_id").join(loyalty, "loyalty_status_id")
    return G.segment_profile(whole, "segment_name")


def score_churn(
    spark: SparkSession, cfg: RunConfig, scorer: str = "boosted", rounds: int = 300
) -> DataFrame:
    """Fit both classifiers, store the scores and the model of one; returns the comparison."""
    facts = stored(
        W.training_table(
            read(spark, cfg, "fact_customers"),
            read(spark, cfg, "dim_loyalty_status"),
            read(spark, cfg, "customer_segments"),
        )
    )
    rows, balanced = C.training_rows(facts, seed=cfg.seed)
    fitted = {
        "logistic": C.fit_logistic(balanced),
        "boosted": C.fit_boosted(balanced, rounds=rounds, seed=cfg.seed),
    }
    if scorer == "newton":
        fitted["newton"] = N.fit_newton(balanced, settings=N.Settings(rounds=rounds, seed=cfg.seed))
    test = rows.where(F.col("split") == "test")
    metrics = [
        E.binary_metrics(c.score(test), "churned", "predicted", "raw_score", name) for name, c in fitted.items()
    ]
    chosen = fitted[scorer]
    scores = C.score_customers(chosen, rows.drop("split")).select(
        "customer_id",
        "churn_score",
        "churn_predicted",
        X.text_or(X.rename_values(F.col("risk_tier"), TIER_NAMES)).alias("risk_tier"),
    )
    versions.replace(scores, cfg.table("churn_scores"))
    save_model(chosen, balanced, cfg.table(f"model_{scorer}"))
    return E.compare_models(metrics, "logistic", "boosted")


def score_new(spark: SparkSession, cfg: RunConfig, customers: DataFrame, scorer: str = "boosted") -> DataFrame:
    """Score customers with the model that an earlier run of ``score_churn`` stored, also in another session."""
    model = load_model(spark, cfg.table(f"model_{scorer}"), customers)
    return C.score_customers(model, customers).withColumn("risk_tier", X.text_or(X.rename_values(F.col("risk_tier"), TIER_NAMES)))


def risk_reports(spark: SparkSession, cfg: RunConfig) -> dict[str, DataFrame]:
    """Reports over the master table, keyed by name; segments and tiers are codes."""
    master = W.master_table(
        read(spark, cfg, "fact_customers"),
        read(spark, cfg, "dim_loyalty_status"),
        read(spark, cfg, "customer_segments"),
        read(spark, cfg, "churn_scores"),
    )
    segment_codes = {name: code for code, name in SEGMENT_NAMES.items()}
    tier_codes = {name: code for code, name in TIER_NAMES.items()}
    coded = master.withColumn("segment", X.rename_values(F.col("segment_name"), segment_codes)).withColumn(
        "risk_tier", X.rename_values(F.col("risk_tier"), tier_codes)
    )
    critical = K.critical_by_segment(coded)
    return {
        "tier_summary": K.tier_summary(coded),
        "counts": R.crosstab(coded, "segment", "risk_tier", TIER_ORDER),
        "percent": R.crosstab_percent(coded, "segment", "risk_tier", TIER_ORDER),
        "critical": critical,
        "hotspot": K.hotspot(critical),
        "recoverable": K.recoverable_or_lost(critical),
        "score_stats": K.score_stats(coded),
        "summary": K.executive_summary(coded),
        "map": K.risk_map(coded, seed=cfg.seed),
    }
