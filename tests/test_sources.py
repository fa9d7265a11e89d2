"""Readers, file sinks and catalog jobs on small files."""

import pytest
from pyspark.sql import functions as F

from tidemill.operators.filters import drop_blank_rows
from tidemill.schemas import MOVIES, PRODUCTS, STORE, TRIPS
from tidemill.sources import catalog, readers, writers


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)
    return str(path)


def test_inferred_csv_with_index_column(spark, tmp_path):
    path = put(tmp_path / "r.csv", ",region_id,region\n0,R1,North\n1,R2,South\n")
    df = readers.read_csv(spark, path)
    assert df.dtypes == [("_c0", "int"), ("region_id", "string"), ("region", "string")]
    assert df.count() == 2


def test_delta_tree_reads_both_timestamp_shapes(spark, tmp_path):
    head = "id,name,created_at,updated_at\n"
    put(tmp_path / "20241031/14/categories.csv", head + "1,a,2024-10-31 14:00:00,2024-10-31 14:00:00\n")
    put(tmp_path / "20241101/00/categories.csv", head + "2,b,2024-11-01,2024-11-01\n")
    put(tmp_path / "20241101/00/users.csv", head)
    put(tmp_path / "20241101/00/subcategories.csv", head + "3,c,2024-11-01,2024-11-01\n")
    put(tmp_path / "date=20241101/hour=01/table=subcategories.csv/part-0.csv", head + "4,d,2024-11-01,2024-11-01\n")
    put(tmp_path / "date=20241101/hour=01/table=categories.csv/part-0.csv", head + "5,e,2024-11-01,2024-11-01\n")
    rows = readers.read_delta_tree(spark, str(tmp_path), "categories", STORE["categories"]).orderBy("id").collect()
    assert [(r.id, r.table_name, r.batch_date, r.batch_hour) for r in rows] == [
        (1, "categories", "20241031", "14"), (2, "categories", "20241101", "00"), (5, "categories", "20241101", "01")]
    assert str(rows[1].created_at) == "2024-11-01 00:00:00"


def test_capitalised_booleans(spark, tmp_path):
    head = "id,user_id,is_refund,created_at,updated_at\n"
    put(tmp_path / "20241031/14/orders.csv", head + "1,2,True,2024-10-31 14:00:00,2024-10-31 14:00:00\n")
    assert readers.read_delta_tree(spark, str(tmp_path), "orders", STORE["orders"]).first().is_refund is True


def test_movie_csv_keeps_quoted_text(spark, tmp_path):
    names = [f.split()[0] for f in MOVIES.split(", ")]
    row = dict.fromkeys(names, "1") | {"overview": '"line one\nline ""two"", end"', "genres": "Drama|Western"}
    path = put(tmp_path / "m.csv", ",".join(names) + "\n" + ",".join(row[n] for n in names) + "\n")
    got = readers.read_csv(spark, path, MOVIES, multiline=True).first()
    assert got.overview == 'line one\nline "two", end' and got.genres == "Drama|Western"


def test_id_list(spark, tmp_path):
    path = put(tmp_path / "ids.csv", "id,x\n30,a\n 10 ,b\nabc\n\n30,c\n20\n")
    ids = readers.read_id_list(spark, path).orderBy("position").collect()
    assert [r.id for r in ids] == ["30", "10", "20"]
    with pytest.raises(ValueError):
        readers.read_id_list(spark, put(tmp_path / "none.csv", "id\nx\n"))


def test_records_of_both_shapes(spark, tmp_path):
    put(tmp_path / "lines/products_1.jsonl", '{"id": 1, "images": ["a", "b"]}\n\n{"id": 2\n{"id": 3, "price": 5}\n')
    put(tmp_path / "arrays/products_2.json", '[\n {"id": 4},\n {"id": 5}\n]')
    put(tmp_path / "arrays/products_3.json", '[{"id": 6},')
    df = readers.read_records(spark, PRODUCTS, str(tmp_path / "lines"), str(tmp_path / "arrays"))
    rows = {r.id: r for r in df.collect() if r.id is not None}
    assert sorted(rows) == [1, 3, 4, 5] and df.count() == 4
    assert rows[1].images == ["a", "b"] and rows[3].price == 5


def test_rss(spark, tmp_path):
    path = put(tmp_path / "feed.xml", """<?xml version="1.0"?><rss><channel><title>T</title>
        <item><link>https://x/y/ep-1</link><title>One &amp; two</title><pubDate>Mon</pubDate><description>d</description></item>
        <item><link>https://x/y/ep-2</link><title>Two</title></item></channel></rss>""")
    rows = readers.read_feed_items(spark, path).orderBy("link").collect()
    assert [(r.title, r.pubDate) for r in rows] == [("One & two", "Mon"), ("Two", None)]


def test_failed_ids(spark, tmp_path):
    put(tmp_path / "errors_1.jsonl", '{"id": 7, "error": "HTTP 404"}\nnoise\n')
    put(tmp_path / "errors_2.jsonl", '{"id": "7", "error": "x"}\n{"error": "y"}\n')
    got = readers.read_failed_ids(spark, str(tmp_path / "errors_*.jsonl"))
    assert [r.id for r in got.collect()] == ["7", "7"]


def test_empty_csv_keeps_its_header(spark, tmp_path):
    writers.write_csv(spark.range(5).filter("id > 9").withColumn("name", F.lit("x")), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_text() == "id,name\n"


def test_explicit_schema_over_nested_folders(spark, tmp_path):
    names = [f.split()[0] for f in TRIPS.split(", ")]
    trips = spark.range(3).selectExpr(*[f"CAST(id AS {f.split()[1]}) {f.split()[0]}" if f.split()[1] != "TIMESTAMP"
                                        else f"TIMESTAMP'2024-01-01' {f.split()[0]}" for f in TRIPS.split(", ")])
    trips.write.parquet(str(tmp_path / "2024/01"))
    trips.write.parquet(str(tmp_path / "2024/02"))
    df = readers.read_parquet(spark, str(tmp_path), TRIPS, recursive=True)
    assert df.columns == names and df.count() == 6


def test_rescued_column_is_dropped(spark):
    df = spark.createDataFrame([(1, None)], "id INT, _rescued_data STRING")
    assert readers.without_rescued(df).columns == ["id"]
    assert readers.without_rescued(spark.range(1)).columns == ["id"]


def test_blank_rows(spark):
    rows = spark.createDataFrame([("Dev", "A"), ("", " "), (None, "\t"), ("Ops", None)], "title STRING, company STRING")
    assert drop_blank_rows(rows).count() == 2


def test_catalog_jobs(spark, tmp_path):
    catalog.recreate_database(spark, "tidemill_test", str(tmp_path / "db"))
    catalog.save_external(spark.range(3), "tidemill_test.ext", str(tmp_path / "ext"))
    catalog.register_location(spark, "tidemill_test.again", str(tmp_path / "ext"))
    assert spark.table("tidemill_test.again").count() == 3
    path = put(tmp_path / "goods.csv", "id,category_id,name,price,created_at,updated_at\n1,2,n,1.5,2024-10-31 14:00:00,2024-10-31 14:00:00\n")
    catalog.load_csv_table(spark, "tidemill_test.goods", STORE["goods"], path)
    catalog.append_rows(spark.createDataFrame([("m", 2)], "name STRING, id INT"), "tidemill_test.goods")
    assert sorted((r.id, r.name, r.price) for r in spark.table("tidemill_test.goods").collect()) == [
        (1, "n", 1.5), (2, "m", None)]
    catalog.rebuild_model(spark.range(1), "tidemill_test.model")
    catalog.rebuild_model(spark.range(2), "tidemill_test.model")
    assert spark.table("tidemill_test.model").count() == 2
    catalog.recreate_database(spark, "tidemill_test", str(tmp_path / "db2"))
    assert [x for x in spark.catalog.listTables("tidemill_test") if not x.isTemporary] == []
