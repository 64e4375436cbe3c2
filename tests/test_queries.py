"""Every query with SQL against DuckDB; the others must return rows."""

import pytest

import __spark_entry__ as entry
import check
from stayline.plans.catalog import base


@pytest.fixture(scope="module")
def duck(folder):
    return check.connect(folder)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(name, spark, folder, duck):
    problem = check.compare(entry.queries()[name](spark, folder), duck, entry.oracle_sql()[name])
    assert problem is None, problem


FAST_MODELS = ["silhouette", "pca_2d", "smote", "export_readback"]


@pytest.mark.parametrize("name", FAST_MODELS)
def test_query_has_rows(name, spark, folder):
    assert entry.queries()[name](spark, folder).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_summaries_leave_payments_alone(spark):
    def tables():
        t = base.Tables(spark, "none")
        t.__dict__["raw"] = {
            "customers": spark.createDataFrame([(1, "a"), (2, "b")], "customer_id long, customer_city string"),
            "orders": spark.createDataFrame(
                [(10, 1, "delivered", "2001-02-03"), (11, 2, "shipped", "2001-03-04"), (12, 2, "canceled", "2001-03-05")],
                "order_id long, customer_id long, order_status string, order_purchase_timestamp string"),
            "order_items": spark.createDataFrame(
                [(10, 5, 3.0, 1.0, 0), (10, 6, 4.0, 1.0, 1), (11, 5, 2.0, 0.0, 0), (12, 6, 9.0, 0.0, 0)],
                "order_id long, product_id long, price double, freight_value double, is_return int"),
            "payments": spark.createDataFrame([(10, 5.0), (11, 2.0)], "order_id long, payment_value double"),
            "products": spark.createDataFrame([(5, "x"), (5, "y"), (6, "x")], "product_id long, product_category_name string"),
            "category_translation": spark.createDataFrame(
                [("x", "audio")], "product_category_name string, product_category_name_english string"),
        }
        return t

    few, all_ = tables(), tables()
    assert "payment_value" not in few.summary._jdf.queryExecution().optimizedPlan().toString()
    names = few.overview.columns
    assert "discount_pct" not in names and "transactions" not in few.__dict__
    assert sorted(few.overview.collect()) == sorted(all_.transactions.select(*names).collect())
    assert sorted(few.summary.collect()) == sorted(all_.summary.collect())  # a product that comes twice counts twice
    assert all_.overview.columns == names
