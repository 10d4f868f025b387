import os
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from millrace import schemas, scratch_path, storage
from millrace.functions import session_time
from millrace.sinks import (
    land_raw_csv,
    publish,
    by_size,
    all_runs,
    run_path,
    write_csv,
    write_json,
    write_parquet,
    write_run_csv,
)
from millrace.operators import watch
from millrace.sources import (
    from_rows,
    object_store_conf,
    read_csv,
    read_csv_by_name,
    read_json,
    read_parquet,
    read_published,
)

RUN_TS = datetime(2024, 5, 6, 7, 8, 9)
ORDERS = [
    (1, 1, Decimal("100.50"), datetime(2024, 1, 1, 0, 0, 0, 123456)),
    (2, 2, Decimal("250.00"), None),
]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_keeps_decimals_and_microseconds(spark, folder):
    df = from_rows(spark, ORDERS, schemas.ORDERS)
    write_csv(df, folder)
    assert rows(read_csv(spark, folder, schemas.ORDERS)) == rows(df)
    assert read_csv(spark, folder).dtypes == [(c, "string") for c in df.columns]


def test_csv_write_replaces(spark, folder):
    write_csv(spark.range(5), folder)
    write_csv(spark.range(2), folder)
    assert read_csv(spark, folder, "id long").count() == 2


TRICKY = ['a "quoted" one', "back\\slash", ' padded ', "comma,", "line\nbreak", "\ttab", "", None, '"', "é漢"]


def test_csv_keeps_every_kind_of_text(spark, folder):
    df = from_rows(spark, list(enumerate(TRICKY)), "id int, text string")
    write_csv(df, folder)
    assert rows(read_csv(spark, folder, df.schema, multi_line=True, keep_empty=True)) == rows(df)
    no_empty = [(i, t or None) for i, t in rows(df)]
    assert rows(read_csv(spark, folder, df.schema, multi_line=True)) == no_empty


@given(st.lists(st.one_of(st.none(), st.text(alphabet='ab ,"\\\n\r\té;', max_size=8)), max_size=12))
@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_csv_and_json_round_trip_any_text(spark, texts):
    df = from_rows(spark, list(enumerate(texts)), "id int, text string")
    csv, json = scratch_path(spark, "csv"), scratch_path(spark, "json")
    write_csv(df, csv)
    write_json(df, json)
    assert rows(read_csv(spark, csv, df.schema, multi_line=True, keep_empty=True)) == rows(df)
    assert rows(read_json(spark, json, df.schema)) == rows(df)


def test_quotes_after_a_blank(spark, folder):
    with open(f"{folder}/in.csv", "w") as f:
        f.write('"Month", "1958", "1959"\n"JAN", 340, 360\n"FEB", , 342\n')
    df = read_csv(spark, folder, trim=True)
    assert df.columns == ["Month", "1958", "1959"]
    assert rows(df) == [("FEB", None, "342"), ("JAN", "340", "360")]


def test_a_cell_that_does_not_fit_stops_the_job(spark, folder):
    with open(f"{folder}/in.csv", "w") as f:
        f.write("order_id,amount\n1,2.5\nx,3\n")
    with pytest.raises(Py4JJavaError, match="order_id|Malformed"):
        read_csv(spark, folder, "order_id int, amount double").collect()
    with pytest.raises(Py4JJavaError, match="header"):
        read_csv(spark, folder, "amount double, order_id int").collect()
    assert read_csv(spark, folder, infer_types=True).dtypes == [("order_id", "string"), ("amount", "double")]


def test_several_files_by_glob(spark, folder):
    for name in ("a", "b"):
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(f"k,v\n{name},1\n")
    assert rows(read_csv(spark, f"{folder}/*.csv")) == [("a", "1"), ("b", "1")]
    assert read_csv(spark, [f"{folder}/a.csv"]).count() == 1


def test_bad_json_stops_the_job(spark, folder):
    with open(f"{folder}/in.json", "w") as f:
        f.write('{"a": 1}\n{bad\n')
    with pytest.raises(Py4JJavaError, match="Malformed"):
        read_json(spark, folder, "a int").collect()


def test_run_paths(spark, folder):
    assert run_path("s3a://raw/", "web", RUN_TS) == "s3a://raw/web_20240506_070809.csv"
    path = write_run_csv(spark.range(3), folder, "ids", RUN_TS)
    assert path == f"{folder}/ids_20240506_070809.csv" and read_csv(spark, path).count() == 3


def test_raw_landing_of_a_split_file_has_a_header_in_every_part(spark, folder):
    os.mkdir(f"{folder}/in")
    with open(f"{folder}/in/big.csv", "w") as f:
        f.write('"k", "v"\n' + "".join(f'"{i}", "x, {i}"\n' for i in range(50_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        path = land_raw_csv(spark, f"{folder}/in/*.csv", f"{folder}/raw", "big", RUN_TS)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) > 3
    landed = read_csv(spark, f"{folder}/raw/*.csv", trim=True)
    assert landed.columns == ["k", "v"] and landed.count() == 50_000
    assert landed.filter("v <> concat('x, ', k)").count() == 0


@pytest.mark.parametrize("trim", [True, False])
def test_raw_landing_keeps_the_text_of_cells(spark, folder, trim):
    os.mkdir(f"{folder}/in")
    with open(f"{folder}/in/a.csv", "w") as f:
        f.write('"k", " v "\n" padded ",  bare\n"say ""hi""", "a, b"\n, ""\n')
    path = land_raw_csv(spark, f"{folder}/in", f"{folder}/raw", "a", RUN_TS)
    landed = read_csv(spark, path, trim=trim)
    assert landed.columns == ["k", " v "]
    assert rows(landed) == rows(read_csv(spark, f"{folder}/in", trim=True))
    assert rows(landed) == [(" padded ", "bare"), ('say "hi"', "a, b"), (None, None)]


def _file(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.mark.parametrize(
    "files",
    [
        ["a,b\n1,2\n3,4,5\n"],
        ["a,b\n1,2\n3\n"],
        ["a,b\n1,2\n", "b,c,a\n1,2,3\n"],
        ["a,b\n1,2\n", "b,a\n1,2\n"],
    ],
)
def test_cells_are_never_lost_or_misplaced(spark, folder, files):
    for i, text in enumerate(files):
        _file(f"{folder}/in/{i}.csv", text)
    with pytest.raises((Py4JJavaError, PySparkException)):
        read_csv(spark, f"{folder}/in").collect()
    with pytest.raises((Py4JJavaError, PySparkException)):
        land_raw_csv(spark, f"{folder}/in/*.csv", f"{folder}/raw", "a", RUN_TS)


def test_files_of_several_headers_are_landed_and_read_by_name(spark, folder):
    _file(f"{folder}/in/0.csv", "a,b\n1,2\n")
    _file(f"{folder}/in/1.csv", "b,c,a\n4,5,3\n")
    _file(f"{folder}/in/2.csv", "a,b\n6,7\n")
    path = land_raw_csv(
        spark, f"{folder}/in/*.csv", f"{folder}/raw", "x", RUN_TS, mixed_headers=True
    )
    assert sorted(os.listdir(path)) == ["header_0", "header_1"]
    found = read_csv_by_name(spark, f"{path}/*")
    assert rows(found.select("a", "b", "c")) == [("1", "2", None), ("3", "4", "5"), ("6", "7", None)]
    _file(f"{folder}/odd/0.csv", '"a\nb",c\n1,2\n')
    with pytest.raises(ValueError, match="line break"):
        read_csv_by_name(spark, f"{folder}/odd")


def test_runs_of_one_name_only(spark, folder):
    for name in ("web", "web_2", "w*b"):
        write_run_csv(spark.range(1).selectExpr(f"'{name}' AS name"), folder, name, RUN_TS)
    for name in ("web", "web_2", "w*b"):
        assert rows(read_csv(spark, all_runs(folder, name))) == [(name,)]


def test_run_times_with_a_zone_show_in_that_of_the_session(spark, folder):
    zoned = datetime(2024, 5, 6, 23, 0, tzinfo=timezone(timedelta(hours=-5)))
    assert write_run_csv(spark.range(1), folder, "z", zoned).endswith("z_20240507_040000.csv")
    assert session_time(spark, RUN_TS) == RUN_TS


def test_partitioned_layout_has_few_files(spark, folder):
    write_parquet(spark.range(0, 1000, 1, 8).selectExpr("id", "id % 2 as half"), folder, ["half"])
    files = [f for _, _, names in os.walk(folder) for f in names if f.startswith("part-")]
    assert len(files) == 2


def test_partitioned_layout_splits_a_hot_value(spark, folder):
    df = spark.range(0, 200_000, 1, 8).selectExpr("id", "if(id % 3 = 0, -1, id % 5) as k", "uuid() as u")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_parquet(df, folder, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = [f for f in os.listdir(f"{folder}/k=-1") if f.startswith("part-")]
    assert len(hot) > 4 and read_parquet(spark, folder).count() == 200_000


def test_partitioned_layout_is_pruned(spark, folder, plan_of):
    write_parquet(spark.range(10).selectExpr("id", "id % 2 as half"), folder, partition_by=["half"])
    df = read_parquet(spark, folder).filter("half = 1")
    assert df.count() == 5 and "PartitionFilters: [isnotnull(half" in plan_of(df)


def test_counts_of_a_partitioned_write_are_above_its_shuffle(spark, folder, plan_of):
    df = spark.range(0, 1000, 1, 8).selectExpr("id", "id % 2 as half")
    observed, _ = watch(df)
    with pytest.raises(ValueError, match="by_size"):
        write_parquet(observed, folder, ["half"])
    observed, counts = watch(by_size(df, "half"))
    plan = plan_of(observed)
    assert plan.index("CollectMetrics") < plan.index("REBALANCE")
    write_parquet(observed, folder, ["half"])
    assert counts.rows == 1000 and read_parquet(spark, folder).count() == 1000


def test_names_of_columns_do_not_look_like_steps(spark, folder):
    """What a column or a literal is called says nothing about the plan."""
    df = spark.range(0, 100, 1, 8).selectExpr("id % 2 AS half", "id AS `RebalancePartitions`", "'CollectMetrics [x]' AS `CollectMetrics`")
    write_parquet(df, folder, ["half"])
    files = [f for _, _, names in os.walk(folder) for f in names if f.startswith("part-")]
    assert len(files) == 2 and read_parquet(spark, folder).count() == 100


def test_publish_replaces_only_a_finished_dataset(spark, folder):
    key = f"{folder}/orders.parquet"
    with pytest.raises(FileNotFoundError):
        read_published(spark, key)
    first = publish(spark.range(3), key)
    publish(spark.range(5), key)
    assert read_published(spark, key).count() == 5
    with pytest.raises(PySparkException):
        publish(spark.range(5).selectExpr("1 div (id - id) as x"), key)

    def refuse():
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        publish(spark.range(7), key, accept=refuse)
    assert read_published(spark, key).count() == 5
    assert read_parquet(spark, first).count() == 3  # kept for those who still read it
    publish(spark.range(6), key)
    assert len(os.listdir(f"{key}.runs")) == 2 and not os.path.exists(first)
    assert len([f for f in os.listdir(key) if f.startswith("_current")]) == 2
    # Who reads the key itself gets an error, not a mixture.
    with pytest.raises(PySparkException):
        spark.read.parquet(key)


def test_a_run_whose_driver_died_does_not_count(spark, folder):
    key = f"{folder}/orders.parquet"
    publish(spark.range(3), key)
    spark.range(9).write.parquet(storage.new_run(key))
    assert read_published(spark, key).count() == 3
    publish(spark.range(4), key)
    assert read_published(spark, key).count() == 4 and len(os.listdir(f"{key}.runs")) == 2


@pytest.mark.parametrize("file_format", ["parquet", "csv", "json"])
def test_publish_of_every_format(spark, folder, file_format):
    df = spark.range(0, 100, 1, 4).selectExpr("id", "concat('a\n', id) as t")
    publish(df, f"{folder}/out", file_format)
    assert rows(read_published(spark, f"{folder}/out", df.schema, file_format)) == rows(df)


def test_publish_of_an_empty_frame(spark, folder):
    publish(spark.range(0), f"{folder}/none")
    assert read_published(spark, f"{folder}/none").count() == 0


def test_object_store_settings():
    assert object_store_conf("http://store:9000", "k", "s") == {
        "spark.hadoop.fs.s3a.endpoint": "http://store:9000",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.access.key": "k",
        "spark.hadoop.fs.s3a.secret.key": "s",
    }
    assert object_store_conf("e", bucket="raw", path_style=False) == {
        "spark.hadoop.fs.s3a.bucket.raw.endpoint": "e",
        "spark.hadoop.fs.s3a.bucket.raw.path.style.access": "false",
    }
    with pytest.raises(ValueError):
        object_store_conf("e", access_key="k")
