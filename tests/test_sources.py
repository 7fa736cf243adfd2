"""Scans, sinks, ingestion and cleaning on small hand-made files."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from shoplens.operators import clean
from shoplens.plans import ingest
from shoplens.plans.explore import explore
from shoplens.plans.publish import publish, report_tables
from shoplens.sources import schemas
from shoplens.sources.catalog import load_raw, load_table, register_views
from shoplens.sources.readers import read_csv
from shoplens.sources.writers import land_in_order, write_event_landing, write_table

TX_HEADER = (
    "created_at,customer_id,booking_id,session_id,product_metadata,payment_method,payment_status,promo_amount,"
    "promo_code,shipment_fee,shipment_date_limit,shipment_location_lat,shipment_location_long,total_amount"
)
FILES = {
    "Customer_master.csv": (
        "customer_id,first_name,last_name,username,email,gender,birthdate,device_type,device_id,device_version,"
        "home_location_lat,home_location_long,home_location,home_country,first_join_date\n"
        "C1, Ann ,Lee,ann,a@x.org,F,1990-02-03,iOS,D1,v1,1.5,100.25, North ,Atlantis,2021-05-06\n"
        "C2,Bob,Ray,bob,b@x.org,M,garbage,Android,D2,v2,,,South,Atlantis,\n"
    ),
    "product.csv": (
        "id,gender,masterCategory,subCategory,articleType,baseColour,season,year,usage,productDisplayName\n"
        '7,Men,Apparel , Topwear,Shirts,Blue,Summer,2020,Casual,"Shirt, blue"\n'
    ),
    "transactions.csv": (
        TX_HEADER + "\n"
        '2023-01-05 10:00:00,C1,B1,S1,"{""items"": [{""product_id"": 7, ""quantity"": 2, ""price"": 5.5}, '
        '{""product_id"": 8, ""quantity"": 1, ""price"": 1.0}]}",Card,Success,,,2.0,2023-01-09,1.0,2.0,14.0\n'
        'garbage,C2,B2,S2,"{""items"": [",Cash,Failed,3.5,SALE20,0.0,never,,,9.0\n'
    ),
    "click_stream.csv": (
        "session_id,event_name,event_time,event_id,traffic_source,event_metadata\n"
        'S1,view_product,2023-01-05 09:59:00,E1,web,"{""page"": ""p, 1"", ""duration_sec"": 12}"\n'
        "S1,checkout,,E2,web,\n"
    ),
}


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name, text in FILES.items():
        (folder / name).write_text(text)
    return str(folder)


def rows(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def test_customers(spark, raw):
    df = ingest.load_clean(spark, "customers", raw).orderBy("customer_id")
    assert len(df.columns) == 15
    assert rows(df, "first_name", "birthdate", "home_location", "first_join_date", "home_location_lat") == [
        ("Ann", date(1990, 2, 3), "North", date(2021, 5, 6), 1.5),
        ("Bob", None, "South", None, None),
    ]


def test_products(spark, raw):
    df = ingest.load_clean(spark, "products", raw)
    assert df.columns[0] == "product_id"
    assert rows(df, "product_id", "masterCategory", "subCategory", "productDisplayName") == [
        (7, "Apparel", "Topwear", "Shirt, blue")
    ]


def test_transactions(spark, raw):
    df = ingest.load_clean(spark, "transactions", raw).orderBy("booking_id")
    good, bad = df.collect()
    assert good.created_at == datetime(2023, 1, 5, 10) and good.shipment_date_limit == date(2023, 1, 9)
    assert [tuple(i) for i in good.parsed_metadata["items"]] == [(7, 2, 5.5), (8, 1, 1.0)]
    assert good.promo_amount == 0.0 and good.promo_code is None
    assert bad.created_at is None and bad.shipment_date_limit is None
    assert bad.promo_amount == 3.5 and bad.parsed_metadata["items"] is None


def test_clickstream(spark, raw):
    df = ingest.load_clean(spark, "clickstream", raw).orderBy("event_id")
    first, second = df.collect()
    assert first.event_time == datetime(2023, 1, 5, 9, 59)
    assert tuple(first.parsed_event_meta) == ("p, 1", 12, None, None, None)
    assert second.event_time is None and second.parsed_event_meta is None


def test_ingest_stores_every_table(spark, raw, tmp_path):
    paths = ingest.ingest(spark, raw, str(tmp_path))
    assert set(paths) == {"customers", "products", "transactions", "clickstream"}
    register_views({name: load_table(spark, name, str(tmp_path)) for name in paths})
    joined = spark.sql(
        "SELECT c.first_name, t.total_amount FROM transactions t JOIN customers c USING (customer_id) ORDER BY 1"
    )
    assert rows(joined) == [("Ann", 14.0), ("Bob", 9.0)]


def test_explore_and_publish(spark, raw, tmp_path):
    tables = {name: ingest.load_clean(spark, name, raw) for name in ingest.CLEANERS}
    found = {name: rows(df) for name, df in explore(tables).items()}
    assert found["table_sizes"] == [
        ("customers", 2, 15), ("products", 1, 10), ("transactions", 2, 15), ("clickstream", 2, 7)
    ]
    assert found["gender"] == [("F", 1, "Female"), ("M", 1, "Male")]
    assert found["join_month"] == [("2021-05", 1)]
    assert found["sub_category"] == [("Apparel", "Topwear", 1)]
    assert found["payment_status"] == [("Failed", 1, 50.0), ("Success", 1, 50.0)]
    assert found["day_of_week"] == [(5, 1, "Thu")] and found["hour_of_day"] == [(10, 1)]
    assert found["funnel_events"] == [(1, "view_product", 1), (3, "checkout", 1)]
    assert found["revenue_by_device"] == [("iOS", 1, 14.0, 14.0)]
    assert found["key_findings"] == [(23.0, 11.5, 50.0, 2, 2, 1, 2)]
    assert sum(r[3] for r in found["order_value"]) == 2
    results = report_tables(tables)
    paths = publish(results, str(tmp_path))
    assert len(paths) == 6
    for name, df in results.items():
        assert rows(read_csv(spark, paths[name], df.schema, stored=True)) == rows(df)


def test_first_folder_with_the_table_wins(spark, raw, tmp_path):
    (tmp_path / "product_new.csv").write_text(FILES["product.csv"].replace("7,Men", "9,Women"))
    assert rows(load_raw(spark, "products", [str(tmp_path), raw]), "id") == [(9,)]
    assert load_raw(spark, "customers", [str(tmp_path), raw]).count() == 2
    with pytest.raises(FileNotFoundError):
        load_raw(spark, "customers", str(tmp_path))


def test_columns_in_another_order_are_bound_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\n1.5,x\n")
    df = read_csv(spark, str(tmp_path / "a.csv"), "a STRING, b DOUBLE")
    assert rows(df) == [("x", 1.5)] and df.columns == ["a", "b"]


def test_another_header_falls_back_to_inference(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,c\n1.5,x\n")
    df = read_csv(spark, str(tmp_path / "a.csv"), "a STRING, b DOUBLE")
    assert dict(df.dtypes) == {"b": "double", "c": "string"}


def test_a_later_file_with_another_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\nx,1.5\n")
    (tmp_path / "b.csv").write_text("b,a\n2.5,y\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_csv(spark, str(tmp_path), "a STRING, b DOUBLE").collect()


def test_csv_keeps_blanks_quotes_and_commas(spark, tmp_path):
    data = [("  x ", 'say "hi", ok', 0.1), (None, "\\", 1e300)]
    df = spark.createDataFrame(data, "a STRING, b STRING, c DOUBLE")
    path = write_table(df, str(tmp_path / "t"), "csv")
    assert sorted(rows(read_csv(spark, path, df.schema, stored=True)), key=str) == sorted(data, key=str)


def test_partitioned_write(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 2 AS part")
    path = write_table(df, str(tmp_path / "p"), partition_by=["part"])
    assert spark.read.parquet(path).where("part = 1").count() == 5


def test_landing_files_are_slices_of_time(spark, tmp_path):
    df = spark.range(1000).selectExpr("id AS event_id", "CAST(id % 50 AS STRING) AS event_time")
    path = write_event_landing(df, str(tmp_path / "landing"), files=4)
    parts = spark.read.json(path).selectExpr("*", "_metadata.file_name AS f")
    spans = parts.groupBy("f").agg({"event_time": "min"}).count()
    assert spans == 4 and parts.count() == 1000


def test_landing_splits_a_shared_timestamp(spark, tmp_path):
    df = spark.range(1000).selectExpr("id AS event_id", "'2024-01-01' AS event_time")
    path = write_event_landing(df, str(tmp_path / "landing"), files=4)
    sizes = spark.read.json(path).selectExpr("_metadata.file_name AS f").groupBy("f").count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 400


def test_files_landed_in_order_hold_successive_times(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, CAST(id * 7 % 1000 AS INT)) AS ts")
    df = df.unionByName(spark.range(3).selectExpr("id", "CAST(NULL AS TIMESTAMP_NTZ) AS ts"))
    path = land_in_order(df, str(tmp_path / "landing"), "ts", slots=4)
    files = sorted((f.stat().st_mtime_ns, str(f)) for f in (tmp_path / "landing").glob("part-*"))
    assert len(files) == 4 and spark.read.parquet(path).count() == 1003
    ends = [spark.read.parquet(f).agg({"ts": "min"}).first()[0] for _, f in files]
    assert ends == sorted(ends)


def test_files_that_share_one_time_are_split_and_later_ones_follow(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' AS ts")
    for _ in range(2):
        path = land_in_order(df, str(tmp_path / "landing"), "ts", slots=4, tie=["id"])
    files = sorted((f.stat().st_mtime_ns, str(f)) for f in (tmp_path / "landing").glob("part-*"))
    firsts = [spark.read.parquet(f).agg({"id": "min"}).first()[0] for _, f in files]
    assert len(files) == 8 and spark.read.parquet(path).count() == 2000
    assert firsts.count(0) == 2 and max(spark.read.parquet(f).count() for _, f in files) < 400


def test_csv_keeps_line_breaks_empty_text_and_microseconds(spark, tmp_path):
    data = [
        ("a\nb", datetime(2024, 1, 1, 1, 2, 3, 123456)), ("\r\\n\\", None), ("", datetime(2024, 1, 1)), (None, None), (r"\N", None), ('"\n"', None),
    ]
    df = spark.createDataFrame(data, "t STRING, at TIMESTAMP_NTZ")
    for fmt, read in (("csv", lambda p: read_csv(spark, p, df.schema, stored=True)), ("json", lambda p: spark.read.schema(df.schema).json(p))):
        path = write_table(df, str(tmp_path / fmt), fmt)
        assert sorted(rows(read(path)), key=str) == sorted(data, key=str)


def test_header_in_another_case_with_a_further_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text("EXTRA,Customer_ID,amt\nx,007,1.5\n")
    df = read_csv(spark, str(tmp_path / "a.csv"), "customer_id STRING, amt DOUBLE")
    assert rows(df) == [("007", 1.5)] and df.columns == ["customer_id", "amt"]
    with pytest.raises(ValueError, match="lacks"):
        read_csv(spark, str(tmp_path / "a.csv"), "customer_id STRING, other DOUBLE", strict=True)


def test_item_json_traps(spark):
    texts = [
        ('{"items": [{"product_id": 1, "quantity": 2, "price": 3.5}]}',),
        ('{"items": [{"product_id": 1,',),
        ('{"items": [{"product_id": "x", "quantity": 2, "price": 3.5}]}',),
        ('[{"product_id": 1}]',),
        (None,),
    ]
    df = clean.parse_json(spark.createDataFrame(texts, "t STRING"), "t", schemas.ORDER_ITEMS_JSON, "p")
    valid, cut, wrong, bare, missing = [r.p for r in df.collect()]
    assert tuple(valid["items"][0]) == (1, 2, 3.5)
    assert cut["items"] is None and bare["items"] is None and missing is None
    assert tuple(wrong["items"][0]) == (None, 2, 3.5)
    assert rows(clean.json_failures(df, "t", "p.items")) == [(4, 2)]


def test_dates_and_timestamps_never_throw(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("2023-01-05",), ("",), ("garbage",), (None,)], "d STRING")
    assert [r.d for r in clean.parse_dates(df, ["d"]).collect()] == [date(2023, 1, 5), None, None, None]
    assert [r.d for r in clean.parse_timestamps(df, ["d"]).collect()] == [datetime(2023, 1, 5), None, None, None]


def test_steps_skip_missing_columns(spark):
    df = spark.createDataFrame([(" a ", None)], "x STRING, y DOUBLE")
    df = clean.clean_strings(df, ["x", "gone"])
    df = clean.fill_nulls(df, {"y": 0.0, "gone": 1})
    df = clean.rename_columns(df, {"x": "z", "gone": "g"})
    df = clean.parse_json(clean.parse_dates(df, ["gone"]), "gone", "k INT", "out")
    assert df.columns == ["z", "y"] and rows(df) == [("a", 0.0)]
