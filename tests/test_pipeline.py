"""Raw CSV files to exports, and restarts from stored phases."""

import csv
import datetime as dt
import random
from dataclasses import replace

import pytest

from stayline.config import Settings
from pyspark.sql import functions as F

from stayline.operators import churn, evaluation, profiling
from stayline.plans.catalog.base import Tables
from stayline.plans.pipeline import Pipeline
from stayline.sources.store import RAW_FILES, load_raw, split_csv

CFG = replace(Settings(), cluster_restarts=1, cluster_range=(3,), max_iter=50)


def write(path, header, rows):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


@pytest.fixture(scope="module")
def raw_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    draw = random.Random(1)
    people, orders, items, pays, reviews = [], [], [], [], []
    for i in range(300):
        who = draw.randrange(60) if draw.random() > 0.33 else 0  # one customer holds a third of the orders
        day = dt.datetime(2017, 1, 1) + dt.timedelta(days=draw.randrange(600), hours=9)
        people.append((f"c{i}", f"u{who}", "1000", "sao paulo", draw.choice(["SP", "RJ", "XX"])))
        status = draw.choice(["delivered", "delivered", "shipped", "canceled"])
        orders.append((f"o{i}", f"c{i}", status, day if i % 50 else "broken", day, "", "", ""))
        for n in range(draw.randint(1, 3)):
            items.append((f"o{i}", n + 1, f"p{draw.randrange(20)}", "s", day, draw.randint(5, 200) + 0.99, 7.5))
        pays.append((f"o{i}", 1, draw.choice(["card", "slip"]), draw.randint(1, 6), draw.randint(5, 300)))
        reviews.append((f"r{i}", f"o{i}", draw.randint(1, 5), "line one\nline two, \"quoted\""))
    pays.append(("o0", 2, "card", 1, "a lot"))
    products = [(f"p{i}", ["brinquedos", "bebes", ""][i % 3]) for i in range(20)]
    tables = {
        "customers": ("customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state", people),
        "orders": ("order_id customer_id order_status order_purchase_timestamp order_approved_at "
                   "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date", orders),
        "order_items": ("order_id order_item_id product_id seller_id shipping_limit_date price freight_value", items),
        "payments": ("order_id payment_sequential payment_type payment_installments payment_value", pays),
        "products": ("product_id product_category_name", products),
        "category_translation": ("product_category_name product_category_name_english",
                                 [("brinquedos", "toys"), ("bebes", "baby")]),
        "reviews": ("review_id order_id review_score review_comment_message", reviews),
    }
    for name, (header, rows) in tables.items():
        write(folder / f"shop_{RAW_FILES[name]}", header.split(), rows)
    return str(folder)


def test_missing_required_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_raw(spark, str(tmp_path))


def test_two_files_for_one_table(spark, raw_folder, tmp_path):
    import shutil

    folder = shutil.copytree(raw_folder, tmp_path / "raw")
    shutil.copy(folder / f"shop_{RAW_FILES['orders']}", folder / f"old_{RAW_FILES['orders']}")
    with pytest.raises(ValueError, match="orders"):
        load_raw(spark, str(folder))


def test_command_line_needs_raw_tables_for_phase_1(capsys):
    from stayline.__main__ import main

    with pytest.raises(SystemExit):
        main(["folder"])
    assert "--raw" in capsys.readouterr().err


ITEMS = "order_id string, order_item_id int, price double"


def test_rejects_of_a_damaged_file(spark, tmp_path):
    lines = ['"order_id",note,order_item_id,price', "a,x,1,2.5", 'b,"x, y",2,', "c,x,two,3", "d,x,4,1,5", "e,x", "", "f,x,1.0,9e2",
             "g,x,no,never", "c,x,two,3", 'h,"say ""no""",7,  ']
    (tmp_path / "items.csv").write_text("\n".join(lines) + "\n")
    good, rejects = split_csv(spark, f"{tmp_path}/items.csv", ITEMS)
    assert sorted(map(tuple, good.collect())) == [("a", 1, 2.5), ("b", 2, None), ("h", 7, None)]
    got = sorted((r["line"], r["column"] or "", r["value"] or "") for r in rejects.collect())
    assert got == [("c,x,two,3", "order_item_id", "two")] * 2 + [
        ("d,x,4,1,5", "", ""), ("e,x", "", ""), ("f,x,1.0,9e2", "order_item_id", "1.0"), ("g,x,no,never", "order_item_id", "no"), ("g,x,no,never", "price", "never")]
    assert all(r["file"].endswith("items.csv") for r in rejects.collect())
    quality = profiling.with_rejects(profiling.table_profile(good, "items"), rejects.withColumn("table_name", F.lit("items"))).first()
    assert (quality["n_rows"], quality["rejected"]) == (3, 6)


def test_rejects_of_free_text_with_line_breaks(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text('order_id,price,said\na,1,"one\ntwo, ""three"""\nb,x,"four\nfive"\nc,2\n')
    good, rejects = split_csv(spark, f"{tmp_path}/reviews.csv", "order_id string, price double, said string", free_text=True)
    assert list(map(tuple, good.collect())) == [("a", 1.0, 'one\ntwo, "three"')]
    got = {(r["column"], r["value"]): r["line"] for r in rejects.collect()}
    assert set(got) == {("price", "x"), (None, None)} and "four\nfive" in got["price", "x"] and got[None, None] == "c,2"


def test_file_with_a_header_alone(spark, tmp_path):
    (tmp_path / "items.csv").write_text("price,order_id\n")
    good, rejects = split_csv(spark, f"{tmp_path}/items.csv", ITEMS)
    assert good.columns == ["order_id", "price"] and good.count() == rejects.count() == 0


REPORTS = [
    "data_quality", "rejects", "segment_profile", "segment_comparison", "segment_agreement", "cluster_profile", "profit_summary",
    "high_revenue_low_margin", "segment_profit", "feature_importance", "attributions", "attribution_means", "top_targets",
    "sensitivity",
]


def test_raw_to_exports_and_restart(spark, raw_folder, tmp_path):
    raw = load_raw(spark, raw_folder)
    assert raw["reviews"].count() == 300 and raw["sellers"] is None
    run = Pipeline(spark, CFG, str(tmp_path))
    final = run.run(raw, models=["Logistic Regression", "Decision Tree"])
    people = {r.customer_unique_id for r in raw["customers"].select("customer_unique_id").collect()}
    rows = {r.customer_id: r for r in final.collect()}
    assert set(rows) == people
    assert all(r.recommended_action and 0 <= r.churn_prob <= 1 and r.kmeans_segment for r in rows.values())
    assert run.load("model_comparison").count() == 2
    reports = {name: run.load(name).count() for name in REPORTS}
    assert reports["data_quality"] == 10 and reports["rejects"] == 1 and reports["sensitivity"] == len(CFG.weight_sets) and reports["segment_agreement"] == 1
    quality = {r.table_name: r for r in run.load("data_quality").collect()}
    assert quality["raw payments"].rejected == 1 and quality["raw payments"].n_rows == 300 and quality["raw orders"].rejected == 0
    assert all(n > 0 for name, n in reports.items() if name != "high_revenue_low_margin")
    exports = run.exports()
    assert exports["customer_master"].count() == len(people)
    assert exports["date_dimension"].count() == 731
    again = {r.customer_id: r for r in run.run(start_phase=6).collect()}
    assert again == rows


def test_transactions_drop_bad_dates_and_keep_categories(spark, raw_folder):
    from stayline.operators import ingest

    txn = ingest.transactions(load_raw(spark, raw_folder), CFG)
    assert txn.filter("order_date is null").count() == 0
    got = {r.product_category: r.product_super_category for r in txn.select("product_category", "product_super_category").distinct().collect()}
    assert got == {"toys": "Baby & Kids", "baby": "Baby & Kids", "other": "Other"}
    assert txn.filter("product_id like 'P_p%' and quantity = 1").count() == txn.count()


def test_leak_free_features_score_lower(spark, folder):
    t = Tables(spark, folder)
    cfg = replace(t.cfg, max_iter=50)
    name = ["Logistic Regression"]
    leaky = churn.train_and_score(t.profitable, t.labels, cfg, name).comparison.first()
    data = churn.leak_free_features(t.customers, t.transactions, t.engagement, cfg)
    fair = churn.train_and_score(data, t.labels, cfg, name).comparison.first()
    assert fair.auc_roc < leaky.auc_roc
