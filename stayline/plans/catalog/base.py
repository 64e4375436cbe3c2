"""Registration of queries, and the tables they share.

A query is registered with its result columns, written as "name:kind": i whole
number, f double compared to 6 digits (f2, f3, ... to fewer), s text, d date. The
kinds are applied to the Spark result and to the SQL in the same way.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.operators import exports, features, ingest, labels, priority, profitability, segmentation
from stayline.plans.catalog.sql import CTES, mean
from stayline.session import tune
from stayline.sources import fixtures
from stayline.sources.store import store

_QUERIES: dict[str, Callable] = {}
_ORACLES: dict[str, str] = {}


class Tables:
    """The test tables of one folder and the phase tables made from them.

    Phase tables are written once to the shared folder, as the pipeline does.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        tune(spark)
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, fixtures.settings()

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> dict:
        return fixtures.raw_tables(self.spark, self.sf_dir)

    def txn(self, *columns: str) -> DataFrame:
        """Transactions, joined only with what the columns need."""
        return ingest.transactions(self.raw, self.cfg, list(columns) or None)

    @cached_property
    def overview(self) -> DataFrame:
        """The columns that the summary of the data looks at, several times."""
        lines = self.lines("order_date", "revenue", "product_id", "product_category", "product_super_category")
        return lines if "transactions" in self.__dict__ else store(lines, "overview")

    @cached_property
    def transactions(self) -> DataFrame:
        return store(self.txn(), "transactions")

    def lines(self, *columns: str) -> DataFrame:
        """Some columns of the transactions: of the stored table if there is one, else joined
        with what the columns need and with the products."""
        if "transactions" in self.__dict__:
            return self.transactions.select(*columns)
        # a product that comes twice doubles its lines, as in the stored table
        return self.txn(*dict.fromkeys([*columns, "product_category"])).select(*columns)

    @cached_property
    def orders(self) -> DataFrame:
        return ingest.resolve_identity(self.raw["orders"], self.raw["customers"])

    @cached_property
    def people(self) -> DataFrame:
        return ingest.customers(self.raw, self.cfg)

    @cached_property
    def customers(self) -> DataFrame:
        return store(self.people, "customers")

    @cached_property
    def counters(self) -> DataFrame:
        return fixtures.engagement(self.spark, self.sf_dir, self.people)

    @cached_property
    def engagement(self) -> DataFrame:
        return store(self.counters, "engagement")

    @cached_property
    def features(self) -> DataFrame:
        return store(
            features.customer_features(self.customers, self.transactions, self.engagement, self.cfg),
            "features",
        )

    @cached_property
    def segmented(self) -> DataFrame:
        return store(segmentation.rfm_score(self.features), "segmented")

    @cached_property
    def statement(self) -> DataFrame:
        return store(
            profitability.customer_profitability(
                self.transactions, self.customers, self.engagement, self.cfg
            ),
            "statement",
        )

    @cached_property
    def profitable(self) -> DataFrame:
        columns = [c for c in profitability.PROFIT_COLUMNS if c in self.statement.columns]
        return store(
            self.segmented.join(self.statement.select(*columns), "customer_id", "left"), "profitable"
        )

    @cached_property
    def labels(self) -> DataFrame:
        txn = self.txn("customer_id", "order_date")
        return labels.churn_labels(txn, self.cfg.split_date, self.cfg.as_of)

    @cached_property
    def scored(self) -> DataFrame:
        """Churn probability from a fixed formula, so that SQL can follow."""
        from stayline.functions.scalars import predicted_flag

        prob = F.col("recency_days") / (F.col("recency_days") + 200.0)
        out = self.profitable.withColumn("churn_prob", prob).withColumn(
            "churn_predicted", predicted_flag("churn_prob")
        )
        return store(labels.with_actual_label(out, self.labels), "scored")

    @cached_property
    def final(self) -> DataFrame:
        return store(priority.prioritise(self.scored, self.cfg), "final")

    @cached_property
    def test_scores(self) -> DataFrame:
        """Labelled customers with the formula's probability."""
        return self.scored.filter(F.col("churn_actual").isNotNull()).select(
            "customer_id", "churn_prob", F.col("churn_actual").alias("churn")
        )

    @cached_property
    def summary(self) -> DataFrame:
        return exports.transactions_summary(
            self.lines("customer_id", "transaction_id", "order_date", "revenue", "quantity", "is_return"))


_TABLES: dict[tuple, Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Phase tables are kept for the life of the session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, sf_dir)
    return _TABLES[key]


def forget_tables() -> None:
    _TABLES.clear()


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.split(":")) for part in spec.split()]


def _digits(kind: str) -> float:
    return float(10 ** int(kind[1:] or 6))


def typed(df: DataFrame, spec: str) -> DataFrame:
    out = []
    for name, kind in _columns(spec):
        c = F.col(name)
        if kind == "i":
            c = c.cast("long")
        elif kind == "d":
            c = c.cast("date").cast("string")
        elif kind == "s":
            c = c.cast("string")
        else:
            scale = _digits(kind)
            c = F.round(c.cast("double") * scale) / scale + F.lit(0.0)
        out.append(c.alias(name))
    return df.select(*out)


def typed_sql(sql: str, spec: str) -> str:
    out = []
    for name, kind in _columns(spec):
        if kind == "i":
            c = f"CAST({name} AS BIGINT)"
        elif kind == "d":
            c = f"CAST(CAST({name} AS DATE) AS VARCHAR)"
        elif kind == "s":
            c = f"CAST({name} AS VARCHAR)"
        else:
            scale = _digits(kind)
            c = f"round(CAST({name} AS DOUBLE) * {scale!r}) / {scale!r} + CAST(0 AS DOUBLE)"
        out.append(f"{c} AS {name}")
    return f"SELECT {', '.join(out)} FROM ({sql}) AS result"


def _names_in(sql: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{n}\b", sql)]


def with_ctes(sql: str) -> str:
    """Puts the shared tables a statement mentions in front of it."""
    sql = re.sub(r"\bavgx\((\w+)\)", lambda m: mean(m[1]), sql)
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _names_in(text):
            if name not in needed:
                visit(CTES[name])
                needed.append(name)

    visit(sql)
    order = [n for n in CTES if n in needed]
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + sql


def query(name: str, spec: str, sql: str | None = None):
    """Register fn(tables) -> DataFrame under a name."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return typed(fn(tables(spark, sf_dir)), spec)

        run.__name__, run.__doc__ = name, fn.__doc__
        assert name not in _QUERIES, name
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = with_ctes(typed_sql(sql, spec))
        return fn

    return register


def queries() -> dict[str, Callable]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
