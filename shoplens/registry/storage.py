"""Sources, sinks and cleaning, each over a whole given table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators import clean
from shoplens.plans import ingest
from shoplens.plans.reports import revenue_ranked
from shoplens.registry import bindings as b
from shoplens.registry.entries import query
from shoplens.scratch import scratch_path
from shoplens.sources.catalog import load_table
from shoplens.sources.readers import read_csv, read_json
from shoplens.sources.rejects import read_csv_checked
from shoplens.sources.schemas import CLICKSTREAM, ORDER_ITEMS_JSON, STREAM_EVENTS
from shoplens.sources.writers import write_table


@query("SELECT * FROM customer")
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Explicit schema, round trip of the customer table."""
    df = load_table(spark, "customer", sf)
    return read_csv(spark, write_table(df, scratch_path(spark, "csv"), "csv"), df.schema, stored=True)


def text_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """The clickstream as its input files hold it: every column text."""
    clicks = b.clickstream(spark, sf)
    return clicks.select(*[F.col(c).cast("string").alias(c) for c in clicks.columns])


_SQL_TEXT_CLICKS = f"""WITH {b.SQL_CLICKS}
SELECT session_id, event_name, event_time, event_id::VARCHAR AS event_id, traffic_source, event_metadata,
       CAST(json_extract(event_metadata, '$.k') AS INTEGER) AS k
FROM clicks"""


def _typed_clicks(raw: DataFrame) -> DataFrame:
    typed = raw.withColumn("event_time", F.col("event_time").try_cast("timestamp_ntz"))
    return clean.parse_json(typed, "event_metadata", "k INT", "meta").withColumn("k", F.col("meta.k")).drop("meta")


@query(_SQL_TEXT_CLICKS)
def csv_json_scan(spark: SparkSession, sf: str) -> DataFrame:
    """JSON inside quoted CSV fields."""
    path = write_table(text_clicks(spark, sf), scratch_path(spark, "csv-json"), "csv")
    return _typed_clicks(read_csv(spark, path, CLICKSTREAM, stored=True))


@query(_SQL_TEXT_CLICKS)
def json_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = write_table(text_clicks(spark, sf), scratch_path(spark, "json"), "json")
    return _typed_clicks(read_json(spark, path, STREAM_EVENTS))


# Text that formats lose easily, by event: as it is, with line breaks, quotes, backslashes, empty, missing, blanks.
_HARD_SQL = r"""SELECT event_id, ts + INTERVAL 1 MICROSECOND * (event_id % 1000000) AS ts,
       CASE event_id % 6 WHEN 0 THEN event_type WHEN 1 THEN event_type || chr(10) || 'two' || chr(13) || 'three'
            WHEN 2 THEN '"' || event_type || '", \n' WHEN 3 THEN '' WHEN 4 THEN NULL ELSE '  ' || event_type || ' ' END AS text
FROM events"""


def _hard_texts(spark: SparkSession, sf: str) -> DataFrame:
    kind, name = F.col("event_id") % 6, F.col("event_type")
    text = (
        F.when(kind == 0, name)
        .when(kind == 1, F.concat(name, F.lit("\ntwo\rthree")))
        .when(kind == 2, F.concat(F.lit('"'), name, F.lit('", \\n')))
        .when(kind == 3, "")
        .when(kind == 5, F.concat(F.lit("  "), name, F.lit(" ")))
    )
    micros = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), ((F.col("event_id") % 1_000_000) / 1e6).cast("decimal(18,6)"))
    return load_table(spark, "events", sf).select("event_id", (F.col("ts") + micros).alias("ts"), text.alias("text"))


@query(_HARD_SQL)
def csv_keeps_everything(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV round trip of microseconds, line breaks, quotes, backslashes, empty text and NULL."""
    df = _hard_texts(spark, sf)
    return read_csv(spark, write_table(df, scratch_path(spark, "hard-csv"), "csv"), df.schema, stored=True)


@query(_HARD_SQL)
def json_keeps_everything(spark: SparkSession, sf: str) -> DataFrame:
    df = _hard_texts(spark, sf)
    return read_json(spark, write_table(df, scratch_path(spark, "hard-json"), "json"), df.schema)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_other_header(spark: SparkSession, sf: str) -> DataFrame:
    """A header in capitals, in another order and with a column that the schema lacks."""
    df = load_table(spark, "customer", sf)
    shown = df.select(F.col("c_acctbal").alias("C_ACCTBAL"), F.lit("x").alias("FURTHER"), F.col("c_name").alias("C_NAME"), F.col("c_custkey").alias("C_CUSTKEY"))
    path = write_table(shown, scratch_path(spark, "csv-header"), "csv")
    return read_csv(spark, path, df.select("c_custkey", "c_name", "c_acctbal").schema, stored=True, strict=True)


@query("""SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part""")
def csv_infer_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The header does not fit the wanted schema, so types are inferred."""
    path = write_table(load_table(spark, "part", sf), scratch_path(spark, "csv-infer"), "csv")
    inferred = read_csv(spark, path, "id INT, gender STRING", stored=True)
    return inferred.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query("SELECT * FROM lineitem")
def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    df = load_table(spark, "lineitem", sf)
    return spark.read.schema(df.schema).parquet(write_table(df, scratch_path(spark, "parquet")))


@query(f"""WITH {b.SQL_ORDERS}
SELECT payment_method, payment_status, count(*) AS num_transactions, {b.near("sum(total_amount)")} AS total_revenue,
       {b.near("avg(total_amount)")} AS avg_order_value,
       dense_rank() OVER (PARTITION BY payment_status ORDER BY sum(total_amount) DESC) AS revenue_rank
FROM orders_v GROUP BY 1, 2""")
def csv_report_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A report stored as CSV and read back under its own schema."""
    report = revenue_ranked(b.orders(spark, sf))
    return read_csv(spark, write_table(report, scratch_path(spark, "report"), "csv"), report.schema, stored=True)


@query("SELECT c_custkey, trim(c_name) AS c_name, trim(c_mktsegment) AS c_mktsegment FROM customer")
def clean_strings(spark: SparkSession, sf: str) -> DataFrame:
    """Blanks are put around the text first, so that there is something to trim."""
    padded = load_table(spark, "customer", sf).select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.concat(F.lit(" "), "c_mktsegment", F.lit("   ")).alias("c_mktsegment"),
    )
    return clean.clean_strings(padded, ["c_name", "c_mktsegment", "no_such_column"])


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE::VARCHAR END AS order_date,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS order_time
FROM orders""")
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates and times from text; the text of pending orders is spoilt and must become NULL."""
    spoilt = F.when(F.col("o_orderstatus") == "P", "n/a ").otherwise("")
    text = load_table(spark, "orders", sf).select(
        "o_orderkey",
        F.concat(spoilt, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        F.concat(spoilt, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("order_time"),
    )
    typed = clean.parse_timestamps(clean.parse_dates(text, ["order_date"]), ["order_time"])
    return typed.withColumns(
        {"order_date": F.col("order_date").cast("string"), "order_time": F.col("order_time").cast("timestamp_ntz")}
    )


@query("SELECT p_partkey AS product_id, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def rename_columns(spark: SparkSession, sf: str) -> DataFrame:
    return clean.rename_columns(load_table(spark, "part", sf), {"p_partkey": "product_id", "id": "unused"})


@query("""SELECT l_orderkey, l_linenumber,
       coalesce(nullif(l_discount, 0), 0.0::DOUBLE) AS l_discount,
       coalesce(nullif(l_returnflag, 'N'), 'none') AS l_returnflag
FROM lineitem""")
def fill_nulls(spark: SparkSession, sf: str) -> DataFrame:
    sparse = load_table(spark, "lineitem", sf).select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
    )
    return clean.fill_nulls(sparse, {"l_discount": 0.0, "l_returnflag": "none", "no_such_column": 0})


def _item_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as item JSON of one to three items: line n % 3 repeats its item n % 3 times more, counted up in quantity."""
    lines = b.order_lines(spark, sf)
    extra = F.sequence(F.lit(0), (F.col("line_number") % 3).cast("int"))
    items = F.transform(
        extra, lambda i: F.struct(F.col("product_id").alias("product_id"), (F.col("quantity") + i).alias("quantity"), F.col("price").alias("price"))
    )
    return lines.select("booking_id", "line_number", F.to_json(F.struct(items.alias("items"))).alias("product_metadata"))


@query("""SELECT l_orderkey AS booking_id, l_linenumber AS line_number, (l_linenumber % 3 + 1)::INTEGER AS num_items,
       l_partkey::INTEGER AS product_id, (l_quantity::INTEGER + i)::INTEGER AS quantity, l_extendedprice AS price
FROM lineitem, range(3) r(i) WHERE i <= l_linenumber % 3""")
def parse_items_json(spark: SparkSession, sf: str) -> DataFrame:
    """Each order line written as JSON of one to three items, parsed back and exploded."""
    text = _item_texts(spark, sf)
    parsed = clean.parse_json(text, "product_metadata", ORDER_ITEMS_JSON, "parsed_metadata")
    items = F.col("parsed_metadata.items")
    return parsed.select("booking_id", "line_number", F.size(items).alias("num_items"), F.inline(items))


@query("""SELECT count(*) AS parsed_rows, count(*) FILTER (l_linenumber % 4 = 0) AS failed_rows FROM lineitem""")
def json_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Every fourth line's text is cut off in the middle and must be counted as unreadable."""
    spoilt = F.when(F.col("line_number") % 4 == 0, F.substring("product_metadata", 1, 12)).otherwise(F.col("product_metadata"))
    texts = _item_texts(spark, sf).withColumn("product_metadata", spoilt)
    parsed = clean.parse_json(texts, "product_metadata", ORDER_ITEMS_JSON, "parsed_metadata")
    return clean.json_failures(parsed, "product_metadata", "parsed_metadata.items")


@query("""SELECT p_partkey::INTEGER AS product_id, p_brand AS gender, trim(p_type) AS "masterCategory", p_name AS "productDisplayName"
FROM part""")
def ingest_products(spark: SparkSession, sf: str) -> DataFrame:
    """A raw product file as the shop delivers it, found by its name, cleaned, stored and read back."""
    blank = F.lit(None).cast("string")
    part = load_table(spark, "part", sf)
    raw = part.select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("gender"), F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("masterCategory"),
        blank.alias("subCategory"), blank.alias("articleType"), blank.alias("baseColour"), blank.alias("season"),
        F.lit(2020).alias("year"), blank.alias("usage"), F.col("p_name").alias("productDisplayName"),
    )
    base = scratch_path(spark, "raw")
    write_table(raw, f"{base}/Products_2020.csv", "csv", nullValue="")
    stored = write_table(ingest.load_clean(spark, "products", base), scratch_path(spark, "products"))
    return spark.read.parquet(stored).select("product_id", "gender", "masterCategory", "productDisplayName")


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, NULL::VARCHAR AS page FROM events""")
def parse_event_props(spark: SparkSession, sf: str) -> DataFrame:
    """A flat struct; a field that the text lacks is NULL."""
    parsed = clean.parse_json(load_table(spark, "events", sf), "props", "k INT, page STRING", "parsed")
    return parsed.select("event_id", "parsed.k", "parsed.page")


@query("""WITH marked AS (
    SELECT *, concat_ws(',', CASE WHEN o_orderkey % 7 = 0 AND o_totalprice IS NOT NULL THEN 'o_totalprice' END,
                             CASE WHEN o_orderkey % 11 = 0 THEN 'o_orderdate' END) AS faults FROM orders)
SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'cells' ELSE nullif(faults, '') END AS reason, count(*) AS num_rows,
       sum(o_orderkey)::BIGINT AS keys
FROM marked GROUP BY 1""")
def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a CSV file with spoilt cells and cut lines: good rows (no reason) and rejected ones, by reason, with all their keys."""
    key = F.col("o_orderkey")
    price = F.when((key % 7 == 0) & F.col("o_totalprice").isNotNull(), "12,50 EUR").otherwise(F.col("o_totalprice").cast("string"))
    date = F.when(key % 11 == 0, "soon").otherwise(F.col("o_orderdate").cast("string"))
    cells = [F.coalesce(c, F.lit("")) for c in (key.cast("string"), F.when(price.isNotNull(), F.concat(F.lit('"'), price, F.lit('"'))), date)]
    line = F.when(key % 13 == 0, key.cast("string")).otherwise(F.concat_ws(",", *cells))
    path = scratch_path(spark, "spoilt-csv")
    load_table(spark, "orders", sf).select(line.alias("value")).write.text(path)
    checked = read_csv_checked(spark, path, "o_orderkey BIGINT NOT NULL, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ", header=False)
    good = checked.good.select(F.lit(None).cast("string").alias("reason"), "o_orderkey")
    bad = checked.rejected.select("reason", F.split("line", ",")[0].cast("bigint").alias("o_orderkey"))
    return good.unionByName(bad).groupBy("reason").agg(F.count("*").alias("num_rows"), F.sum("o_orderkey").alias("keys"))
