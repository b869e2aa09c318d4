"""Sinks, table listing and names."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from daymart.operators import clear_scratch, settle
from daymart.operators.scratch import scratch_path
from daymart.plans.registry import QUERIES
from daymart.sources import (
    TEMPORARY,
    check_export_names,
    export_name,
    export_parquet,
    export_relational,
    list_tables,
    publish_model,
    read_raw_events,
    read_series,
    read_table,
    save_table,
    write_csv,
)
from daymart.sources.writers import relational_options


@pytest.fixture
def numbers(spark):
    return spark.range(10).withColumn("year", F.col("id") % 2 + 2020)


@pytest.mark.parametrize(
    "table, flat",
    [("main_fact", "fact"), ("main_main_fact", "fact"), ("main_x_main_y", "x_y"), ("dim_main_x", "dim_main_x"), ("dim", "dim")],
)
def test_export_names(table, flat):
    assert export_name(table) == flat


def test_colliding_exports_fail_before_writing(numbers, tmp_path):
    with pytest.raises(ValueError, match="fact"):
        export_parquet({("a", "main_fact"): numbers, ("b", "fact"): numbers}, str(tmp_path))
    assert not os.listdir(tmp_path)
    with pytest.raises(ValueError):
        check_export_names(["x", "x"])


def test_export_twice_leaves_one_copy(spark, numbers, tmp_path):
    for _ in range(2):
        paths = export_parquet({("main", "main_n"): numbers}, str(tmp_path))
    assert paths == [f"{tmp_path}/n.parquet"]
    assert sorted(read_table(spark, paths[0]).collect()) == sorted(numbers.collect())


def test_save_table_by_year(spark, numbers, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        save_table(numbers, path, ["year"])
    assert sorted(d for d in os.listdir(path) if d.startswith("year=")) == ["year=2020", "year=2021"]
    assert read_table(spark, path).count() == 10


def test_comma_csv(numbers, tmp_path):
    write_csv(numbers.coalesce(1), str(tmp_path / "c"), sep=",")
    lines = next((tmp_path / "c").glob("*.csv")).read_text().splitlines()
    assert lines[:2] == ["id,year", "0,2020"]


def test_publish_and_list(spark, numbers, tmp_path):
    publish_model(numbers, "numbers_view", "view")
    stored = publish_model(numbers, "numbers_table", "table", str(tmp_path / "n"))
    assert "FileScan" in stored._jdf.queryExecution().executedPlan().toString()
    numbers.write.mode("overwrite").saveAsTable("numbers_saved")
    listed = list_tables(spark)
    assert {(TEMPORARY, "numbers_view"), (TEMPORARY, "numbers_table"), ("default", "numbers_saved")} <= set(listed)
    assert listed[("default", "numbers_saved")].count() == listed[(TEMPORARY, "numbers_view")].count() == 10
    spark.sql("DROP TABLE numbers_saved")
    for kind in ("table", "other"):
        with pytest.raises(ValueError):
            publish_model(numbers, "x", kind)


def test_a_table_and_views_of_one_name_are_all_listed(spark, numbers):
    spark.sql("CREATE DATABASE IF NOT EXISTS main")
    numbers.limit(3).write.mode("overwrite").saveAsTable("main.same_name")
    numbers.createOrReplaceTempView("same_name")
    numbers.limit(5).createOrReplaceGlobalTempView("same_name")
    listed = list_tables(spark)
    found = {key[0]: df.count() for key, df in listed.items() if key[1] == "same_name"}
    assert found == {"main": 3, TEMPORARY: 10, "global_temp": 5}
    spark.catalog.dropTempView("same_name")
    spark.catalog.dropGlobalTempView("same_name")
    spark.sql("DROP DATABASE main CASCADE")


def test_models_live_in_their_schema(spark, numbers):
    for _ in range(2):
        publish_model(numbers, "dim_n", schema="dims")
    assert spark.table("dims.dim_n").count() == 10
    assert ("dims", "dim_n") in list_tables(spark)
    with pytest.raises(ValueError):
        publish_model(numbers, "v", "view", schema="dims")
    spark.sql("DROP DATABASE dims CASCADE")


def test_text_survives_csv(spark, tmp_path):
    texts = [" Tallinn ", 'a "quoted" b', "x;y,z", "two\nlines", "", "plain"]
    df = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "k string, t string")
    for sep in ";,":
        write_csv(df, str(tmp_path / f"csv{ord(sep)}"), sep=sep)
        back = read_raw_events(spark, str(tmp_path / f"csv{ord(sep)}"), sep=sep)
        assert sorted(r["t"] or "" for r in back.collect()) == sorted(texts)


def test_long_rows_fail_and_short_ones_are_filled(spark, tmp_path):
    (tmp_path / "short.csv").write_text("a;b;c\n1;2\n3;4;5\n")
    assert sorted(map(tuple, read_raw_events(spark, str(tmp_path / "short.csv")).collect())) == [("1", "2", None), ("3", "4", "5")]
    (tmp_path / "long.csv").write_text("a;b\n1;2\n3;4;5\n")
    with pytest.raises(Exception, match="more than 2 fields: 3;4;5"):
        read_raw_events(spark, str(tmp_path / "long.csv")).select("a").collect()


@pytest.mark.parametrize("line", ['{"date": "05.01.2020", "rain_sum": 1.0}', '{"date": "2020-01-05", "rain_sum": "abc"}', "no json", '{"rain_sum": 1.0}'])
def test_unreadable_documents_fail(spark, tmp_path, line):
    (tmp_path / "s.json").write_text('{"date": "2020-01-04", "rain_sum": 2.0}\n')
    assert read_series(spark, str(tmp_path / "s.json"), "json").count() == 1
    (tmp_path / "bad.json").write_text('{"date": "2020-01-04", "rain_sum": 2.0}\n' + line + "\n")
    with pytest.raises(Exception):
        read_series(spark, str(tmp_path / "bad.json"), "json").collect()


def test_scratch_on_a_cluster_must_be_shared(spark, monkeypatch):
    from types import SimpleNamespace

    def session(folder, **conf):
        settings = {"spark.checkpoint.dir": folder, **conf}
        context = SimpleNamespace(master="spark://host:7077", applicationId="app", getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))

    for folder in ("file:/tmp/x", "/tmp/x"):
        with pytest.raises(RuntimeError):
            scratch_path(session(folder), "x")
    assert scratch_path(session("hdfs://store/x"), "y").startswith("hdfs://store/x/")
    assert scratch_path(session("/x", **{"spark.hadoop.fs.defaultFS": "hdfs://store"}), "y").startswith("/x/")
    assert scratch_path(session("file:/mnt/x", **{"spark.daymart.sharedMount": "true"}), "y").startswith("file:/mnt/x/")


def test_scratch_on_a_cluster_tries_a_folder_without_a_store(spark, numbers, monkeypatch):
    """A path of one machine by its name is taken when all tasks see the files of the others."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(folder)
    assert settle(numbers, "x").count() == numbers.count()
    assert len(list(Path(folder).glob(f"daymart-{spark.sparkContext.applicationId}/trial-*"))) == 1  # tried once
    assert QUERIES["first_rows"](spark, "/root/testdata/sf0.001").count() == 5


def test_scratch_on_a_cluster_without_a_folder_is_in_the_warehouse(spark, tmp_path):
    """Neither refused nor put in a temporary folder of the driver, which executors do not have."""
    from types import SimpleNamespace

    def session(master, warehouse):
        settings = {"spark.sql.warehouse.dir": warehouse}
        context = SimpleNamespace(master=master, applicationId=f"app-{master[:6]}", defaultParallelism=2, getCheckpointDir=lambda: None)
        conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
        return SimpleNamespace(sparkContext=context, conf=conf, range=spark.range, read=spark.read)

    for master in ("spark://host:7077", "local-cluster[3,2,3000]"):
        assert scratch_path(session(master, f"file:{tmp_path}"), "x").startswith(f"file:{tmp_path}/daymart-app-")
        assert scratch_path(session(master, "hdfs://store/x"), "x").startswith("hdfs://store/x/daymart-app-")
    assert len(list(tmp_path.glob("*/trial-*"))) == 2
    with pytest.raises(RuntimeError):
        scratch_path(session("spark://host:7077", None), "x")


def test_scratch_on_a_cluster_refuses_a_folder_that_lacks_files(spark, tmp_path):
    from types import SimpleNamespace

    def session(seen):
        context = SimpleNamespace(master="spark://host:7077", applicationId=f"app-{seen}", defaultParallelism=2, getCheckpointDir=lambda: None)
        reader = SimpleNamespace(schema=lambda _: SimpleNamespace(parquet=lambda _: spark.range(seen)))
        settings = {"spark.checkpoint.dir": str(tmp_path)}
        conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
        return SimpleNamespace(sparkContext=context, conf=conf, range=spark.range, read=reader)

    with pytest.raises(RuntimeError, match="do not share"):
        scratch_path(session(7), "x")  # one of eight tasks wrote elsewhere
    assert scratch_path(session(8), "x").startswith(str(tmp_path))


def test_relational_options(numbers):
    assert relational_options("jdbc:x", "main_fact", 4, 500) == {
        "url": "jdbc:x",
        "dbtable": "main_fact",
        "numPartitions": "4",
        "batchsize": "500",
        "truncate": "true",
    }
    with pytest.raises(ValueError, match="a_b_c"):
        export_relational({("a", "b_c"): numbers, ("a_b", "c"): numbers}, "jdbc:x", {})


def test_scratch_lives_in_the_configured_folder(spark, numbers):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert path != scratch_path(spark, "x")
    assert settle(numbers, "x").dtypes == numbers.dtypes


def test_scratch_can_be_cleared(spark, numbers, tmp_path, monkeypatch):
    root = tmp_path / "scratch"
    monkeypatch.setattr("daymart.operators.scratch._scratch_root", lambda _: str(root))
    settle(numbers, "x")
    assert len(list(root.iterdir())) == 1
    clear_scratch(spark)
    assert not root.exists()
