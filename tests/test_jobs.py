import uuid
from datetime import datetime
from decimal import Decimal

import pytest

from millrace import jobs, schemas
from millrace.sinks import replace_table
from millrace.sources import from_rows, read_parquet, read_table


def test_word_count_job(spark, folder, capsys):
    with open(f"{folder}/in.txt", "w") as f:
        f.write("hello world\nhello \n")
    jobs.main(["word-count", f"{folder}/in.txt", "--output", f"{folder}/out"], spark)
    counts = {tuple(r) for r in read_parquet(spark, f"{folder}/out").collect()}
    assert counts == {("hello", 2), ("world", 1), ("", 1)}
    jobs.main(["word-count", f"{folder}/in.txt", "--drop-trailing-empty"], spark)
    shown = capsys.readouterr().out
    assert "hello: 2" in shown and "world: 1" in shown
    with open(f"{folder}/many.txt", "w") as f:
        f.write(" ".join(f"w{i}" for i in range(500)))
    jobs.main(["word-count", f"{folder}/many.txt"], spark)
    assert len(capsys.readouterr().out.splitlines()) == 500


def test_batch_ingest_job(spark, folder, capsys):
    source, target = f"s_{uuid.uuid4().hex}", f"t_{uuid.uuid4().hex}"
    orders = from_rows(spark, [(1, 1, Decimal("2.50"), datetime(2024, 1, 1))], schemas.ORDERS)
    replace_table(orders, source, f"{folder}/source")
    roots = ["--raw", f"{folder}/raw", "--processed", f"{folder}/processed"]
    table = ["--table", target, "--table-location", f"{folder}/target"]
    jobs.main(["batch-ingest", source, *roots, *table], spark)
    assert read_table(spark, target).first()["amount"] == Decimal("2.50")
    assert "landed 1 rows, transformed 1" in capsys.readouterr().out


def test_orders_are_dealt_out_evenly_on_request(monkeypatch):
    asked = []
    monkeypatch.setattr(jobs.sources, "read_jdbc", lambda spark, db, *rest: asked.append(rest))
    base = ["batch-ingest", "orders", "--url", "jdbc:mysql://h/db", "--raw", "r", "--processed", "p"]
    for more in ([], ["--even-partitions", "--partitions", "2"]):
        jobs._orders(None, jobs.parser().parse_args([*base, *more]))
    assert asked[0] == ("orders", "order_id", 64, None)
    assert asked[1][3] == ["(ABS(MOD(`order_id`, 2)) = 0 OR `order_id` IS NULL)", "ABS(MOD(`order_id`, 2)) = 1"]


def test_csv_etl_job(spark, folder):
    target = f"t_{uuid.uuid4().hex}"
    with open(f"{folder}/in.csv", "w") as f:
        f.write("JAN,1958\na,1\nb,\n")
    roots = ["--raw", f"{folder}/raw", "--transformed", f"{folder}/transformed", "--name", "web"]
    table = ["--table", target, "--table-location", f"{folder}/target"]
    clean = ["--rename", "JAN=January", "--not-null", "1958", "--infer-types", "--this-run-only"]
    jobs.main(["csv-etl", f"{folder}/in.csv", *roots, *table, *clean], spark)
    assert [r.asDict() for r in read_table(spark, target).collect()] == [{"January": "a", "1958": 1}]


def test_csv_etl_job_with_line_breaks_and_several_headers(spark, folder):
    target = f"t_{uuid.uuid4().hex}"
    for name, text in (("a", 'x,y\n"1\n2",3\n'), ("b", "y,x\n4,5\n")):
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(text)
    roots = ["--raw", f"{folder}/raw", "--transformed", f"{folder}/transformed", "--name", "web"]
    table = ["--table", target, "--table-location", f"{folder}/target"]
    jobs.main(["csv-etl", f"{folder}/*.csv", *roots, *table, "--multi-line", "--mixed-headers"], spark)
    assert sorted(tuple(r) for r in read_table(spark, target).select("x", "y").collect()) == [("1\n2", "3"), ("5", "4")]


def test_jobs_load_into_a_database(spark, folder, monkeypatch):
    sent = []
    monkeypatch.setattr(jobs.sinks, "replace_jdbc_table", lambda frame, db, table, connect: sent.append((frame.count(), db.url, table, connect())))
    monkeypatch.setattr(jobs.importlib, "import_module", lambda name: type(name, (), {"connect": staticmethod(lambda **o: (name, o))}))
    with open(f"{folder}/in.csv", "w") as f:
        f.write("a\n1\n2\n")
    roots = ["--raw", f"{folder}/raw", "--transformed", f"{folder}/transformed", "--name", "web"]
    target = ["--target-url", "jdbc:mysql://h/db", "--table", "t", "--db-module", "pymysql", "--db-option", "user=u"]
    jobs.main(["csv-etl", f"{folder}/in.csv", *roots, *target], spark)
    assert sent == [(2, "jdbc:mysql://h/db", "t", ("pymysql", {"user": "u"}))]
    with pytest.raises(SystemExit):
        jobs.main(["csv-etl", f"{folder}/in.csv", *roots, "--target-url", "jdbc:mysql://h/db"], spark)


def test_publish_job_needs_its_topic(spark, folder):
    from_rows(spark, [], schemas.SENSOR_EVENT).write.parquet(f"{folder}/in")
    with pytest.raises(SystemExit):
        jobs.main(["publish-events", f"{folder}/in", "--brokers", "b", "--checkpoint", "c"], spark)
