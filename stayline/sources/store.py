"""Stored tables: phase tables, raw CSV input and dashboard exports."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.session import shared_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder of the session."""
    return f"{shared_dir(spark).rstrip('/')}/stayline/{uuid.uuid4().hex}/{name}"


def save(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).option("header", True).save(path)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write df as parquet once and read it back: later steps prune columns and
    see the same rows whatever happens to executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    save(df, path)
    return spark.read.schema(df.schema).parquet(path)


# -- raw CSV input ------------------------------------------------------------

# Raw table -> columns read from its CSV file.
RAW_SCHEMAS = {
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                 "customer_city string, customer_state string",
    "orders": "order_id string, customer_id string, order_status string, "
              "order_purchase_timestamp string, order_approved_at string, "
              "order_delivered_carrier_date string, order_delivered_customer_date string, "
              "order_estimated_delivery_date string",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, "
                   "shipping_limit_date string, price double, freight_value double",
    "payments": "order_id string, payment_sequential int, payment_type string, "
                "payment_installments int, payment_value double",
    "products": "product_id string, product_category_name string",
    "category_translation": "product_category_name string, product_category_name_english string",
    "reviews": "review_id string, order_id string, review_score int",
}
REQUIRED = ["customers", "orders", "order_items", "payments", "products", "category_translation"]
OPTIONAL = ["reviews", "sellers", "geolocation"]

# Raw table -> end of its file name; any prefix may stand before it.
RAW_FILES = {
    "customers": "customers_dataset.csv",
    "orders": "orders_dataset.csv",
    "order_items": "order_items_dataset.csv",
    "payments": "order_payments_dataset.csv",
    "products": "products_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
    "reviews": "order_reviews_dataset.csv",
    "sellers": "sellers_dataset.csv",
    "geolocation": "geolocation_dataset.csv",
}


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that a pattern finds."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(pattern)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return [f.getPath().toString() for f in place.getFileSystem(conf).globStatus(place) or []]


def exists(spark: SparkSession, pattern: str) -> bool:
    return bool(matches(spark, pattern))


def split_csv(
    spark: SparkSession, path: str, columns: str | None = None, free_text: bool = False
) -> tuple[DataFrame, DataFrame]:
    """CSV files, each with the same header, in one pass: their good rows, columns matched by name and
    typed as asked (all as text if nothing is asked), and their rejects (file, line, column, value).

    A line is rejected, whole, if it has more or fewer fields than the header (column is null then),
    or if a field that is not blank cannot be read as its type: one reject a field. Only free
    text can hold line breaks in quotes, and its rejected lines are written anew from their
    fields; other files stay splittable and lines come as they stand in the file.
    """
    names = spark.read.csv(path, header=True, escape='"').columns
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_whole"}
    schema = ", ".join(f"_c{i} string" for i in range(len(names))) + ", _whole string"
    raw = [F.col(f"_c{i}") for i in range(len(names))]
    file = F.col("_metadata.file_path").alias("file")
    if free_text:
        rows = spark.read.csv(path, schema, header=True, enforceSchema=True, multiLine=True, **options)
        line = F.coalesce("_whole", F.to_csv(F.struct(*raw), {"escape": '"'}))
        rows = rows.select("*", file, line.alias("line"))
    else:
        text = spark.read.text(path)
        header = text.filter("_metadata.file_block_start = 0").first()
        lines = text.filter(F.trim("value") != "").filter(F.col("value") != F.lit(header["value"] if header else ""))
        rows = lines.select(F.from_csv("value", schema, options).alias("row"), file, F.col("value").alias("line"))
        rows = rows.select("row.*", "file", "line")
    asked = T.StructType.fromDDL(columns).fields if columns else [T.StructField(n, T.StringType()) for n in names]
    wanted = [(f, raw[names.index(f.name)]) for f in asked if f.name in names]
    unread = [
        F.when((F.trim(c) != "") & c.try_cast(f.dataType).isNull(), F.struct(F.lit(f.name).alias("column"), c.alias("value")))
        for f, c in wanted if f.dataType != T.StringType()
    ]
    broken = F.when(F.col("_whole").isNotNull(), F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"))))
    found = F.filter(F.array(*unread), lambda x: x.isNotNull()) if unread else F.array().cast("array<struct<column:string,value:string>>")
    rows = rows.withColumn("_faults", F.coalesce(broken, found)).withColumn("_bad", (F.size("_faults") > 0).cast("int"))
    out = rows.select(
        *[c.try_cast(f.dataType).alias(f.name) for f, c in wanted],
        *[F.when(F.col("_bad") == 1, F.col(c)).alias(f"_{c}") for c in ("file", "line")], "_faults", "_bad")
    place = scratch(spark, "split")
    out.write.partitionBy("_bad").parquet(place)
    stored = spark.read.schema(out.schema).parquet(place)
    good = stored.filter("_bad = 0").select(*[f.name for f, _ in wanted])
    rejects = stored.filter("_bad = 1").select(F.col("_file").alias("file"), F.col("_line").alias("line"), F.explode("_faults").alias("fault"))
    return good, rejects.select("file", "line", "fault.column", "fault.value")


def load_raw(spark: SparkSession, folder: str, fmt: str = "csv") -> dict:
    """Required tables, and optional ones where their file is there.

    CSV files are found by the end of their name, and two files with the same end are
    an error; lines that cannot be read are left out of their table and listed in `rejects`
    (table_name, file, line, column, value). Parquet tables are folders or files named after
    the table.
    """
    out, rejects = {}, []
    for name in REQUIRED + OPTIONAL:
        path = f"{folder}/*{RAW_FILES[name]}" if fmt == "csv" else f"{folder}/{name}.parquet"
        if not exists(spark, path):
            if name in REQUIRED:
                raise FileNotFoundError(f"required table {name} is missing: {path}")
            out[name] = None
        elif fmt == "csv":
            if len(files := matches(spark, path)) > 1:
                raise ValueError(f"more than one file for table {name}: {', '.join(files)}")
            out[name], bad = split_csv(spark, path, RAW_SCHEMAS.get(name), free_text=name == "reviews")
            rejects.append(bad.select(F.lit(name).alias("table_name"), "*"))
        else:
            out[name] = spark.read.parquet(path)
    if rejects:
        out["rejects"] = reduce(DataFrame.unionByName, rejects)
    return out
