"""The seven phases. Each reads stored tables and stores its result, so a run can
start at any phase."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.config import Settings
from stayline.operators import (
    churn, clustering, explain, exports, features, ingest, labels, priority, profiling, profitability,
    segmentation,
)
from stayline.session import tune
from stayline.sources.phases import Phases
from stayline.sources.store import save


def lookup_frame(spark: SparkSession, mapping: dict, key: str, value: str) -> DataFrame:
    """A lookup dictionary as a two-column table."""
    return spark.createDataFrame(list(mapping.items()), [key, value])


def save_base_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict:
    """Write customers, transactions and engagement; returns them read back."""
    for name, df in tables.items():
        save(df, f"{folder}/{name}", fmt)
    spark = next(iter(tables.values())).sparkSession
    return {
        name: spark.read.schema(df.schema).option("header", True).format(fmt).load(f"{folder}/{name}")
        for name, df in tables.items()
    }


def export_tables(final: DataFrame, txn: DataFrame, spark: SparkSession, cfg: Settings) -> dict:
    """The seven dashboard tables."""
    return {
        "customer_master": exports.customer_master(final),
        "transactions_summary": exports.transactions_summary(txn),
        "retention_decisions": exports.retention_decisions(final),
        "segment_summary": exports.segment_summary(final),
        "date_dimension": exports.date_dimension(spark, cfg.start_date, cfg.as_of),
        "geographic_summary": exports.geographic_summary(final, regions=cfg.regions),
        "category_performance": exports.category_performance(txn),
    }


SMALL_EXPORTS = {"retention_decisions", "segment_summary", "date_dimension", "geographic_summary",
                 "category_performance"}


def write_exports(tables: dict[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """Write each table; only those of a bounded size go into one file."""
    for name, df in tables.items():
        save(df.coalesce(1) if name in SMALL_EXPORTS else df, f"{folder}/{name}", fmt)


def read_back(spark: SparkSession, names, folder: str) -> DataFrame:
    """Rows, columns and bytes of each written table."""
    out = None
    for name in names:
        df = spark.read.csv(f"{folder}/{name}", header=True, escape='"')
        files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"),
            files.agg(F.sum("file_size")).scalar().alias("n_bytes"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def committed(name: str):
    """A method whose tables become the result of a phase together, when it has ended."""

    def wrap(method):
        @wraps(method)
        def run(self, *args, **kwargs):
            with self.phases.phase(name):
                return method(self, *args, **kwargs)

        return run

    return wrap


class Pipeline:
    """Phases over a folder of stored tables. A phase reads only tables of finished phases with the
    same settings, none of which has been replaced by a later run of an earlier phase."""

    def __init__(self, spark: SparkSession, cfg: Settings, folder: str):
        tune(spark)
        self.spark, self.cfg, self.folder = spark, cfg, folder.rstrip("/")
        self.phases = Phases(spark, self.folder, cfg)

    def load(self, name: str) -> DataFrame:
        return self.phases.load(name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return self.phases.keep(df, name)

    def adopt(self, phase: str, tables: dict[str, DataFrame]) -> None:
        """Store tables made elsewhere as the result of a phase."""
        with self.phases.phase(phase):
            for name, df in tables.items():
                self.keep(df, name)

    @committed("base")
    def base(self, raw: dict) -> dict[str, DataFrame]:
        """Phase 1: customers, transactions, engagement."""
        people = self.keep(ingest.customers(raw, self.cfg), "customers")
        txn = self.keep(ingest.transactions(raw, self.cfg), "transactions")
        eng = self.keep(ingest.engagement(people, txn, raw, self.cfg), "engagement")
        stored = {"customers": people, "transactions": txn, "engagement": eng}
        quality = profiling.union_profiles([profiling.table_profile(df, n) for n, df in stored.items()])
        rejects = raw.get("rejects")
        if rejects is not None:
            rejects = self.keep(rejects, "rejects")
            read = {f"raw {n}": df for n, df in raw.items() if n != "rejects" and df is not None}
            quality = quality.unionByName(profiling.table_inventory(read))
            rejects = rejects.withColumn("table_name", F.concat(F.lit("raw "), "table_name"))
        self.keep(profiling.with_rejects(quality, rejects), "data_quality")
        return {"customers": people, "transactions": txn, "engagement": eng}

    @committed("features")
    def features(self) -> DataFrame:
        """Phase 2."""
        out = features.customer_features(
            self.load("customers"), self.load("transactions"), self.load("engagement"), self.cfg
        )
        return self.keep(out, "customer_features")

    @committed("segmentation")
    def segmentation(self, clusters: bool = True) -> DataFrame:
        """Phase 3: rule-based segments and, unless switched off, k-means clusters."""
        out = segmentation.rfm_score(self.load("customer_features"))
        if clusters:
            out = clustering.kmeans_segments(self.keep(out, "customer_scored"), self.cfg)[0]
        out = self.keep(out, "customer_segmented")
        self.keep(segmentation.segment_profile(out), "segment_profile")
        if clusters:
            cells, agreement = segmentation.compare(out, "rfm_segment", "kmeans_segment")
            self.keep(cells, "segment_comparison")
            self.keep(agreement, "segment_agreement")
            self.keep(clustering.cluster_profile(out), "cluster_profile")
        return out

    @committed("profitability")
    def profitability(self) -> DataFrame:
        """Phase 4."""
        out = profitability.add_profitability(
            self.load("customer_segmented"), self.load("transactions"), self.load("customers"),
            self.load("engagement"), self.cfg,
        )
        out = self.keep(out, "customer_profitable")
        self.keep(profitability.profit_summary(out), "profit_summary")
        self.keep(profitability.high_revenue_low_margin(out), "high_revenue_low_margin")
        self.keep(profitability.segment_profit(out), "segment_profit")
        return out

    @committed("churn")
    def churn(self, models: list[str] | None = None) -> DataFrame:
        """Phase 5: train, compare, keep the best model and score every customer."""
        txn = self.load("transactions")
        target = labels.churn_labels(txn, self.cfg.split_date, self.cfg.as_of)
        run = churn.train_and_score(self.load("customer_profitable"), target, self.cfg, models)
        self.keep(run.comparison, "model_comparison")
        self.keep(churn.feature_importance(run.models, run.columns), "feature_importance")
        parts = self.keep(explain.shap_contributions(run.best, run.test, run.columns), "attributions")
        self.keep(explain.mean_size(parts, run.columns), "attribution_means")
        churn.save_model(run.best, self.spark, self.phases.place("model"))
        return self.keep(run.scored, "customer_churn")

    @committed("priority")
    def priority(self) -> DataFrame:
        """Phase 6."""
        final = self.keep(priority.prioritise(self.load("customer_churn"), self.cfg), "customer_retention_final")
        self.keep(priority.decision_matrix(final), "decision_matrix")
        self.keep(priority.top_targets(final), "top_targets")
        self.keep(priority.sensitivity_analysis(final, self.cfg), "sensitivity")
        return final

    def exports(self) -> dict[str, DataFrame]:
        """Phase 7."""
        tables = export_tables(
            self.load("customer_retention_final"), self.load("transactions"), self.spark, self.cfg
        )
        write_exports(tables, f"{self.folder}/exports")
        return tables

    def run(self, raw: dict | None = None, start_phase: int = 1, models: list[str] | None = None) -> DataFrame:
        """All phases from start_phase on; earlier results are read from the folder."""
        steps = [
            lambda: self.base(raw), self.features, self.segmentation, self.profitability,
            lambda: self.churn(models), self.priority, self.exports,
        ]
        for step in steps[start_phase - 1:]:
            step()
        return self.load("customer_retention_final")
