import os
import uuid
from datetime import datetime
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from millrace import schemas
from millrace.operators import ValidationError
from millrace.plans import run_batch_ingest, run_csv_etl
from millrace.sinks import jdbc
from millrace.sources import JdbcDatabase, from_rows, read_csv, read_parquet, read_published, read_table

RUN_TS = datetime(2024, 5, 6, 7, 8, 9)
T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
SEED = [
    (1, 1, Decimal("100.50"), T1),
    (2, 2, Decimal("250.00"), T1),
    (3, 3, Decimal("75.25"), T1),
    (4, 4, Decimal("500.75"), T1),
    (5, 5, Decimal("13.00"), T1),
]


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def ingest(spark, folder, rows, name=None, **options):
    return run_batch_ingest(
        from_rows(spark, rows, schemas.ORDERS).repartition(3),
        f"{folder}/raw",
        f"{folder}/processed",
        name,
        f"{folder}/table",
        RUN_TS,
        **options,
    )


@pytest.mark.parametrize("options", [{}, {"landing_format": "parquet"}])
def test_batch_ingest(spark, folder, name, options):
    rows = [*SEED, (5, 5, Decimal("99.00"), T2)]
    result = ingest(spark, folder, rows, name, **options)
    assert (result.landed_rows, result.transformed_rows) == (6, 5)
    assert sorted(map(tuple, read_table(spark, name).collect())) == [
        (i, c, a, RUN_TS) for i, c, a, _ in SEED
    ]
    totals = read_parquet(spark, result.aggregated_path)
    assert {tuple(r) for r in totals.collect()} == {(c, float(a), float(a), 1) for _, c, a, _ in SEED}
    assert read_parquet(spark, result.transformed_path).columns == [
        *schemas.ORDERS.names, "processed_timestamp",
    ]


def test_extra_columns_pass_whole(spark, folder):
    notes = ["line\nbreak", "", None, 'say "hi", twice', " padded "]
    rows = [(*row, note) for row, note in zip(SEED, notes)]
    schema = schemas.ORDERS.simpleString().removeprefix("struct<").removesuffix(">")
    df = spark.createDataFrame(rows, schema + ",note:string")
    result = run_batch_ingest(df, f"{folder}/raw", f"{folder}/processed", run_ts=RUN_TS)
    out = read_parquet(spark, result.transformed_path).orderBy("order_id")
    assert [r["note"] for r in out.collect()] == notes


def test_landed_file_is_csv_of_the_source(spark, folder):
    result = ingest(spark, folder, SEED)
    landed = read_csv(spark, result.landed_path, schemas.ORDERS)
    assert sorted(map(tuple, landed.collect())) == SEED and result.table is None


def test_bad_data_stops_the_run_and_leaves_the_last_one(spark, folder, name):
    first = ingest(spark, folder, SEED, name)
    with pytest.raises(ValidationError) as error:
        ingest(spark, folder, [(6, 1, Decimal("-1.00"), T1), (7, 1, Decimal("0.00"), T1)], name)
    assert [(v.column, v.check, v.failures) for v in error.value.violations] == [
        ("amount", "greater_than(0)", 2)
    ]
    assert read_csv(spark, first.landed_path).count() == 5
    assert read_table(spark, name).count() == 5
    assert len(os.listdir(f"{folder}/raw/orders/orders.csv.runs")) == 1


def test_run_again_replaces(spark, folder, name):
    ingest(spark, folder, SEED, name)
    result = ingest(spark, folder, SEED[:2], name)
    assert read_table(spark, name).count() == 2
    assert read_parquet(spark, result.transformed_path).count() == 2


def test_empty_source_empties_the_target(spark, folder, name):
    ingest(spark, folder, SEED, name)
    result = ingest(spark, folder, [], name)
    assert (result.landed_rows, result.transformed_rows) == (0, 0)
    assert read_table(spark, name).count() == 0
    assert read_parquet(spark, result.aggregated_path).count() == 0


def test_load_by_function(spark, folder):
    seen = []
    result = run_batch_ingest(
        from_rows(spark, SEED, schemas.ORDERS),
        f"{folder}/raw",
        f"{folder}/processed",
        lambda df: seen.append(df.count()),
        run_ts=RUN_TS,
    )
    assert seen == [5] and result.table is None


def test_a_csv_landing_with_text_has_files_of_bounded_size(spark, folder):
    """One partition with long texts; a file with line breaks is read by one task."""
    orders = spark.range(0, 4000, 1, 1).selectExpr(
        "cast(id as int) as order_id", "1 as customer_id", "cast(1 as decimal(10,2)) as amount",
        "timestamp'2024-01-01' as order_date", "concat_ws('\\n', transform(sequence(1, 12), x -> sha2(concat(id, ' ', x), 256))) as note",
    )
    small = {"advisoryPartitionSizeInBytes": "200k", "coalescePartitions.minPartitionSize": "50k"}
    for name, value in small.items():
        spark.conf.set(f"spark.sql.adaptive.{name}", value)
    try:
        result = run_batch_ingest(orders, f"{folder}/raw", f"{folder}/processed", run_ts=RUN_TS)
    finally:
        for name in small:
            spark.conf.unset(f"spark.sql.adaptive.{name}")
    sizes = [os.path.getsize(f"{result.landed_path}/{f}") for f in os.listdir(result.landed_path) if f.startswith("part-")]
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 3
    assert result.landed_rows == 4000 == read_parquet(spark, result.transformed_path).count()


def test_orders_and_landings_stay_at_their_keys(spark, folder):
    ingest(spark, folder, SEED)
    ingest(spark, folder, SEED[:3])
    assert read_published(spark, f"{folder}/raw/orders/orders.csv", schemas.ORDERS, "csv").count() == 3
    key = f"{folder}/processed/orders/orders_transformed.parquet"
    assert read_published(spark, key).count() == 3
    with pytest.raises(ValidationError):
        ingest(spark, folder, [(6, 1, Decimal("-1.00"), T1)])
    assert read_published(spark, f"{folder}/raw/orders/orders.csv", schemas.ORDERS, "csv").count() == 3


def test_load_into_a_database(spark, folder, monkeypatch):
    """A plan's load gets a frame that is read from files, as the JDBC loads ask for."""
    calls = []
    monkeypatch.setattr(jdbc, "_stage", lambda df, *rest: calls.append(df.inputFiles()))
    monkeypatch.setattr(jdbc, "_create_empty", lambda *rest: None)
    monkeypatch.setattr(jdbc, "_run", lambda connect, statements, *rest: calls.append(statements))
    database = JdbcDatabase("jdbc:mysql://host/db")
    load = lambda df: jdbc.load_jdbc_table(df, database, "out", schemas.ORDERS_TRANSFORMED, None)
    result = run_batch_ingest(
        from_rows(spark, SEED, schemas.ORDERS), f"{folder}/raw", f"{folder}/processed", load, run_ts=RUN_TS
    )
    assert result.table is None and len(calls[0]) > 0
    assert calls[1][0] == "DELETE FROM `out`"


def test_table_needs_a_location(spark, folder):
    with pytest.raises(ValueError, match="table_location"):
        run_batch_ingest(from_rows(spark, SEED, schemas.ORDERS), f"{folder}/r", f"{folder}/p", "t")


WEB = '"Month", "JAN", "1958", "1959"\n"a", "x", 340, 360\n"b", "y", , 342\n'


def etl(spark, folder, name=None, run_ts=RUN_TS, **options):
    return run_csv_etl(
        spark,
        f"{folder}/in/*.csv",
        f"{folder}/raw",
        f"{folder}/transformed",
        "web",
        name,
        f"{folder}/table",
        names={"JAN": "January"},
        not_null=["1958"],
        run_ts=run_ts,
        **options,
    )


@pytest.fixture
def web(folder):
    os.mkdir(f"{folder}/in")
    with open(f"{folder}/in/web.csv", "w") as f:
        f.write(WEB)


def test_csv_etl(spark, folder, name, web):
    result = etl(spark, folder, name)
    assert result.raw_path == f"{folder}/raw/web_20240506_070809.csv"
    assert result.transformed_path == f"{folder}/transformed/web_transformed_20240506_070809.csv"
    table = read_table(spark, name)
    assert table.dtypes == [("Month", "string"), ("January", "string"), ("1958", "string"), ("1959", "string")]
    assert list(map(tuple, table.collect())) == [("a", "x", "340", "360")]


def test_csv_etl_covers_the_landings_of_all_runs(spark, folder, name, web):
    later = datetime(2024, 5, 7)
    etl(spark, folder, name)
    etl(spark, folder, name, run_ts=later)
    assert read_table(spark, name).count() == 2
    etl(spark, folder, name, run_ts=later, this_run_only=True, infer_types=True)
    table = read_table(spark, name)
    assert table.count() == 1 and dict(table.dtypes)["1958"] == "int"


def test_csv_etl_reads_no_landing_of_another_name(spark, folder, web):
    def flow(name, text, run_ts=RUN_TS, **options):
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(text)
        found = []
        run_csv_etl(
            spark, f"{folder}/{name}.csv", f"{folder}/raw", f"{folder}/transformed", name,
            lambda df: found.extend(map(tuple, df.collect())), run_ts=run_ts, **options,
        )
        return sorted(found)

    assert flow("first", "a,b\n1,2\n") == [("1", "2")]
    assert flow("first_2", "c\n5\n") == [("5",)]
    assert flow("second", "b,a\n3,4\n") == [("3", "4")]
    assert flow("first", "a,b\n6,7\n", datetime(2024, 5, 7)) == [("1", "2"), ("6", "7")]
    # A run whose files have other columns stops, unless cells go by name.
    with pytest.raises(ValueError, match="other columns"):
        flow("first", "b,a\n9,8\n", datetime(2024, 5, 8))
    assert flow("mixed", "a,b\n1,2\n", mixed_headers=True) == [("1", "2")]
    assert flow("mixed", "b,a\n9,8\n", datetime(2024, 5, 8), mixed_headers=True) == [("1", "2"), ("8", "9")]


def test_line_breaks_in_cells(spark, folder):
    with open(f"{folder}/in.csv", "w") as f:
        f.write('a,b\n"one\ntwo",2\n')
    found = []
    run_csv_etl(
        spark, f"{folder}/in.csv", f"{folder}/raw", f"{folder}/transformed", "x",
        lambda df: found.extend(map(tuple, df.collect())), run_ts=RUN_TS, multi_line=True,
    )
    assert found == [("one\ntwo", "2")]
