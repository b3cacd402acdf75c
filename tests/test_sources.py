"""Loading, appending, rebuilding."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.operators import forecast, gold
from larder.plans.refresh import COLD_CHAIN, RefreshError, models, refresh
from larder.session import work_path
from larder.sources import ingest, lenses
from larder.sources.tables import Lake
from larder.streaming.incremental import ingest_new_files

SF = "/root/testdata/sf0.001"


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_full_load_is_repeatable(lake, tmp_path):
    path = put(tmp_path / "raw" / "t.csv", "id,name,at\n1,x,2024-01-01 10:00:00\n2,,\n")
    for _ in range(2):
        df = ingest.ingest_csv(lake, path, "t")
    assert df.columns == ["id", "name", "at", "_loaded_at", "_source_file"]
    rows = df.orderBy("id").collect()
    assert rows[0]["at"] == dt.datetime(2024, 1, 1, 10) and rows[1]["name"] is None
    assert {r._source_file for r in rows} == {path} and len(rows) == 2


def test_incremental(lake, tmp_path):
    load = lambda text: ingest.ingest_incremental(lake, put(tmp_path / "t.csv", text), "t", "id")
    assert load("id,v\n1,a\n5,b\n") == 2
    # 3 arrives late and is skipped, as is the repeated 5
    assert load("id,v\n3,late\n5,b\n6,c\n7,d\n") == 4
    assert sorted(r.id for r in lake.read("bronze", "t").collect()) == [1, 5, 6, 7]
    lake.write(lake.read("bronze", "t").limit(0), "bronze", "t2")
    empty = ingest.ingest_incremental(lake, put(tmp_path / "t2.csv", "id,v\n1,a\n"), "t2", "id")
    assert empty == 1


def test_incremental_stream(spark, lake, tmp_path):
    folder = tmp_path / "landing"
    put(folder / "a.csv", "id,v\n1,a\n5,b\n")
    run = lambda: ingest_new_files(
        lake, str(folder), "t", "id", spark.createDataFrame([], "id int, v string").schema, str(tmp_path / "cp")
    )
    assert run() == 2
    assert run() == 2
    put(folder / "b.csv", "id,v\n3,late\n6,c\n")
    assert run() == 3


def test_folder(lake, tmp_path):
    put(tmp_path / "raw" / "a.csv", "x\n1\n")
    put(tmp_path / "raw" / "b.csv", "y\n1\n2\n")
    put(tmp_path / "raw" / "c.txt", "no")
    loaded = ingest.ingest_dir(lake, str(tmp_path / "raw"))
    assert {k: v.count() for k, v in loaded.items()} == {"a": 1, "b": 2}
    (tmp_path / "none").mkdir()
    with pytest.warns(UserWarning, match="no CSV"):
        assert ingest.ingest_dir(lake, str(tmp_path / "none")) == {}


def test_wall_clock_is_kept(lake, tmp_path):
    path = put(tmp_path / "iot.csv", "timestamp,temp_celsius\n2020-07-12 00:01:34.385+07,22.5\n")
    df = ingest.ingest_csv(lake, path, "iot", timestamp_format="%Y-%m-%d %H:%M:%S.%f+07")
    assert df.first().timestamp == dt.datetime(2020, 7, 12, 0, 1, 34, 385000)
    assert ingest.datetime_pattern("%Y-%m-%d %H:%M:%S.%f+07") == "yyyy-MM-dd HH:mm:ss.SSSSSS'+07'"


def test_copy_csv(spark, tmp_path):
    one = put(tmp_path / "1.csv", "a,b\n3,007\n")
    two = put(tmp_path / "2.csv", "a,b\n1,x\n")
    out = ingest.copy_csv(spark, [one, two], str(tmp_path / "out"), rename={"b": "c"}, sort_by=["a"])
    assert [tuple(r) for r in out.orderBy("a").collect()] == [("1", "x"), ("3", "007")]


def test_layers_in_folder_and_catalog(spark, lake):
    assert lake.ensure_layers() == ["bronze", "gold", "silver"]
    assert not lake.exists("gold", "nothing")
    named = Lake(spark)
    assert named.ensure_layers() == ["bronze", "gold", "silver"]
    for _ in range(2):
        named.write(spark.range(3), "silver", "numbers")
    assert named.exists("silver", "numbers") and named.append(spark.range(2), "silver", "numbers").count() == 5
    assert not named.exists("gold", "numbers")


def test_predictions_grow(spark, lake):
    start = dt.date(2023, 1, 1)
    demand = spark.createDataFrame(
        [(start + dt.timedelta(days=i), 100 + i % 7) for i in range(120)] + [(None, 5)], "date_id date, daily_sales_qty bigint"
    )
    assert forecast.retrain_and_append(lake, demand) == 7
    assert forecast.retrain_and_append(lake, demand) == 14
    ds = sorted({r.ds for r in lake.read("gold", "ml_demand_predictions").collect()})
    assert ds[0] == dt.datetime(2023, 5, 1) and len(ds) == 7
    assert forecast.retrain_and_append(lake, demand.filter("date_id is null")) is None


def test_refresh(spark, lake):
    for name in ("retail_data", "m5_forcasting", "SupplyChain", "iot_telemetry"):
        lake.write(lenses.BRONZE[name](spark, SF), "bronze", name)
    done = refresh(lake)
    assert set(done) == set(models(lake))
    for name, model in models(lake).items():
        assert all(done.index(i) < done.index(name) for i in model.inputs if i in done)
    kpi = lake.read("gold", "executive_kpi").count()
    # Tables that do not need each other are ready in any order.
    assert sorted(refresh(lake, select=COLD_CHAIN)) == sorted(COLD_CHAIN)
    assert lake.read("gold", "executive_kpi").count() == kpi
    waste = gold.food_waste(
        lake.read("silver", "fact_sales"), lake.read("silver", "dim_product"),
        lake.read("silver", "fact_inventory"), lake.read("silver", "dim_store"),
    )
    assert waste.count() == lake.read("gold", "food_waste_summary").count()


def test_refresh_query_keeps_stock_of_leap_days_apart(spark, tmp_path):
    import os

    from compare import TABLES, compare, duck

    from larder.catalog import entries

    con = duck(SF)
    for t in TABLES:
        if t != "lineitem":
            os.symlink(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    day = "CASE l_linenumber WHEN 1 THEN DATE '1996-02-28' WHEN 2 THEN DATE '1996-02-29' ELSE l_shipdate END"
    con.execute(
        f"COPY (SELECT * REPLACE (CAST({day} AS {con.execute('SELECT typeof(l_shipdate) FROM lineitem LIMIT 1').fetchall()[0][0]}) AS l_shipdate, "
        f"l_partkey % 10 AS l_partkey, l_suppkey % 2 AS l_suppkey) FROM lineitem) TO '{tmp_path}/lineitem.parquet'"
    )
    assert compare(spark, duck(str(tmp_path)), "s9_refresh", entries()["s9_refresh"], str(tmp_path)) is None


def test_refresh_stops_at_the_first_failure(spark, lake):
    lake.write(spark.range(3).select(F.col("id").alias("wrong")), "bronze", "retail_data")
    with pytest.raises(RefreshError, match="silver"):
        refresh(lake, select=["silver.fact_sales", "gold.daily_demand"])
    assert not lake.exists("gold", "daily_demand")


def test_staged_files_go_with_their_block(spark):
    from larder.session import stage, staged_files_removed

    with staged_files_removed(spark):
        path = stage(spark.range(3), "test").inputFiles()[0].rsplit("/", 1)[0]
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_work_paths_lie_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = work_path(spark, "x")
    assert path != work_path(spark, "x")
    assert root is None or path.startswith(root)


def test_csv_keeps_quotes_and_line_breaks(spark, lake, tmp_path):
    path = put(tmp_path / "q.csv", 'id,text\n1,"he said ""hi"", ok"\n2,"two\nlines"\n3,"  kept  "\n')
    rows = ingest.ingest_csv(lake, path, "q").orderBy("id").collect()
    assert [r.text for r in rows] == ['he said "hi", ok', "two\nlines", "  kept  "]
    copied = ingest.copy_csv(spark, [path], str(tmp_path / "copy"))
    assert sorted(r.text for r in copied.collect()) == sorted(r.text for r in rows)


def test_cells_that_do_not_fit_raise(spark, tmp_path):
    path = put(tmp_path / "bad.csv", "id,v\n1,2\n2,x\n")
    schema = spark.createDataFrame([], "id int, v int").schema
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|CAST|parse"):
        ingest.read_csv(spark, path, schema).collect()
    late = put(tmp_path / "late.csv", "id,timestamp\n1,yesterday\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|CAST|parse"):
        ingest.read_csv(spark, late, timestamp_format="%Y-%m-%d %H:%M:%S").collect()


@pytest.mark.parametrize("digits", ["3", "38", "385", "385123"])
def test_fractions_of_a_second(spark, tmp_path, digits):
    path = put(tmp_path / "t.csv", f"id,timestamp\n1,2020-07-12 00:01:34.{digits}+07\n")
    row = ingest.read_csv(spark, path, timestamp_format="%Y-%m-%d %H:%M:%S.%f+07").first()
    assert row["timestamp"] == dt.datetime(2020, 7, 12, 0, 1, 34, int(digits.ljust(6, "0")))


def test_a_failed_rebuild_keeps_the_table(spark, lake):
    lake.write(spark.range(5).toDF("id"), "silver", "t")
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception):
        lake.write(broken, "silver", "t")
    assert lake.read("silver", "t").count() == 5
    assert lake.write(spark.range(3).toDF("id"), "silver", "t").count() == 3


def test_clustered_files_hold_ranges(spark, lake):
    rows = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("k"))
    stored = lake.write(rows, "silver", "c", cluster_by="k")
    per_file = stored.groupBy(F.input_file_name()).agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a for x, y in zip(per_file, per_file[1:]))


def test_equality_reaches_the_parquet_reader(spark, lake):
    from larder.operators.silver import where_equal

    stored = lake.write(spark.createDataFrame([("F", 1), ("O", 2)], "s string, n int"), "bronze", "e")
    plan = where_equal(stored, "s", "F").select("n")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(s,F)" in plan


def test_clusters_need_a_shared_folder():
    from types import SimpleNamespace

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_path(cluster, "x")


def test_the_package_is_handed_to_executors(spark):
    import zipfile

    from larder import session

    session.ship_package(spark)
    files = [f for f in spark.sparkContext._python_includes if f.endswith("larder.zip")]
    assert files and spark.sparkContext.applicationId in session._shipped
    from pyspark import SparkFiles

    names = zipfile.ZipFile(SparkFiles.get("larder.zip")).namelist()
    assert "larder/operators/forecast.py" in names and "larder/__init__.py" in names


def test_old_table_comes_back_when_the_new_one_cannot_take_its_place(spark, lake, monkeypatch):
    one, two = (spark.range(n).withColumn("v", F.lit(n)) for n in (3, 5))
    lake.write(one, "silver", "kept")
    real = Lake._rename
    monkeypatch.setattr(Lake, "_rename", lambda self, a, b: False if b == self.path("silver", "kept") else real(self, a, b))
    with pytest.raises(OSError, match="could not take the place"):
        lake.write(two, "silver", "kept")
    monkeypatch.undo()
    assert lake.read("silver", "kept").count() == 3
    assert lake.write(two, "silver", "kept").count() == 5


def test_table_set_aside_by_a_job_that_was_cut_off_is_found(spark, lake):
    lake.write(spark.range(4), "silver", "cut")
    assert lake._rename(lake.path("silver", "cut"), lake.path("silver", "_cut-old-1"))
    assert lake.read("silver", "cut").count() == 4
    catalog = Lake(spark)
    catalog.ensure_layers()
    catalog.write(spark.range(4), "silver", "cut")
    spark.sql("ALTER TABLE silver.cut RENAME TO silver.cut__old")
    assert catalog.read("silver", "cut").count() == 4
    assert catalog.write(spark.range(6), "silver", "cut").count() == 6
    assert not catalog.exists("silver", "cut__old")
    spark.sql("DROP TABLE silver.cut")


def test_equality_reaches_the_reader(spark):
    from larder.catalog.silver import equality_scan

    plan = equality_scan(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(device_mac), EqualTo(device_mac,dev-1)]" in plan
    assert "humidity_pct" not in plan


def rows_read(df) -> int:
    """Rows that the scan of ``df`` handed on when it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while not plan.children().isEmpty():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("catalog", [False, True])
def test_bloom_filters_skip_row_groups(spark, lake, catalog):
    """Keys in no order: minimum and maximum of a file say nothing, its Bloom filter does."""
    where = Lake(spark) if catalog else lake
    where.ensure_layers()
    rows = spark.range(160_000, numPartitions=8).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    there, absent = (spark.range(1).select(F.md5(F.lit(x))).first()[0] for x in ("77", "-1"))
    plain = where.write(rows, "silver", "hashed")
    assert rows_read(plain.filter(F.col("k") == there)) == 160_000
    stored = where.write(rows, "silver", "hashed", bloom=["k"])
    found = stored.filter(F.col("k") == there)
    assert [r.id for r in found.collect()] == [77] and 0 < rows_read(found) <= 40_000
    assert rows_read(stored.filter(F.col("k") == absent)) <= 20_000
    # Appended files have their own filters.
    more = where.append(rows.withColumn("k", F.concat("k", F.lit("x"))), "silver", "hashed", bloom=["k"])
    assert more.count() == 320_000 and rows_read(more.filter(F.col("k") == there + "x")) <= 60_000
    if catalog:
        spark.sql("DROP TABLE silver.hashed")


def test_rebuild_stores_sales_once_and_reads_the_other_raw_tables_where_they_are(spark, monkeypatch):
    from larder.catalog import entries

    stored, write = [], Lake.write

    def noted(lake, df, layer, name, *args, **more):
        stored.append(f"{layer}.{name}")
        return write(lake, df, layer, name, *args, **more)

    monkeypatch.setattr(Lake, "write", noted)
    entries()["s9_refresh_rows"].run(spark, SF)
    assert [n for n in stored if n.startswith("bronze.")] == ["bronze.retail_data"]


def test_attached_table_gives_way_to_a_stored_one(spark, lake):
    lake.attach(spark.range(3), "bronze", "a")
    assert lake.read("bronze", "a").count() == 3 and not lake.exists("bronze", "a")
    with pytest.raises(ValueError, match="attached"):
        lake.append(spark.range(1), "bronze", "a")
    assert lake.write(spark.range(5), "bronze", "a").count() == lake.read("bronze", "a").count() == 5


def test_rebuilt_facts_hold_ranges_of_days(spark, lake):
    lake.attach(lenses.retail_data(spark, SF), "bronze", "retail_data")
    lake.attach(lenses.supply_chain(spark, SF), "bronze", "SupplyChain")
    lake.attach(lenses.m5_forcasting(spark, SF), "bronze", "m5_forcasting")
    days = {"fact_sales": "order_date_id", "fact_purchase_order": "order_date_id", "fact_inventory": "date_id"}
    refresh(lake, select=[f"silver.{n}" for n in days])
    for name, day in days.items():
        table = lake.read("silver", name)
        assert all(f.endswith(".zstd.parquet") for f in table.inputFiles())
        per_file = table.groupBy(F.input_file_name()).agg(F.min(day).alias("a"), F.max(day).alias("b")).orderBy("a", "b").collect()
        assert all(x.b <= y.a for x, y in zip(per_file, per_file[1:]))
