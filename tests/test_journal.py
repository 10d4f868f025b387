"""Flows that go on where they stopped."""

import uuid
from datetime import datetime
from decimal import Decimal

import pytest

from millrace import jobs, schemas, storage
from millrace.journal import Journal
from millrace.operators import ValidationError
from millrace.plans import batch_ingest, run_batch_ingest, run_csv_etl
from millrace.sinks import replace_table
from millrace.sources import from_rows, read_parquet, read_table

T1 = datetime(2024, 1, 1)
ROWS = [(i, i % 3, Decimal(i + 1), T1) for i in range(20)]


def ingest(spark, folder, load=None, version="v1", rows=ROWS, **options):
    return run_batch_ingest(
        from_rows(spark, rows, schemas.ORDERS), f"{folder}/raw", f"{folder}/processed", load, f"{folder}/table",
        journal=f"{folder}/journal", source_version=version, **options,
    )


def runs(spark, folder):
    return Journal(spark, f"{folder}/journal").runs()


def test_finished_steps_do_not_run_again(spark, folder):
    failures = [RuntimeError("the database is away")]
    seen = []

    def load(frame):
        if failures:
            raise failures.pop()
        seen.append(frame.count())

    with pytest.raises(RuntimeError, match="away"):
        ingest(spark, folder, load)
    assert runs(spark, folder) == {"begin": (1, 1), "land": (1, 1), "transform": (1, 1), "aggregate": (1, 1), "load": (1, 0)}
    result = ingest(spark, folder, load)
    assert seen == [20] and (result.landed_rows, result.transformed_rows) == (20, 20)
    assert runs(spark, folder) == {"begin": (1, 1), "land": (1, 1), "transform": (1, 1), "aggregate": (1, 1), "load": (2, 1)}
    # A third start has nothing to do.
    assert ingest(spark, folder, load) == result and seen == [20]


STEPS = ["begin", "land", "transform", "aggregate", "load"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("at", ["work", "result", "mark"])
def test_a_failure_anywhere_is_resumed(spark, folder, monkeypatch, step, at):
    table, plain = f"t_{uuid.uuid4().hex}", Journal.step

    def failing(self, name, given, work, outputs=()):
        if name != step:
            return plain(self, name, given, work, outputs)

        def broken(*_):
            raise OSError("the driver died")

        with monkeypatch.context() as dying:
            if at == "work":
                return plain(self, name, given, broken, outputs)
            if at == "result":
                dying.setattr(storage, "write_bytes", broken)
                return plain(self, name, given, work, outputs)
            real = storage.create_empty
            dying.setattr(storage, "create_empty", lambda s, p: broken() if p.endswith(".done") else real(s, p))
            return plain(self, name, given, work, outputs)

    with monkeypatch.context() as patched:
        patched.setattr(Journal, "step", failing)
        with pytest.raises(OSError, match="died"):
            ingest(spark, folder, table)
    result = ingest(spark, folder, table)
    assert read_table(spark, table).count() == 20 and read_parquet(spark, result.transformed_path).count() == 20
    done = STEPS.index(step)
    assert [n for _, (n, _) in sorted(runs(spark, folder).items(), key=lambda x: STEPS.index(x[0]))] == [
        *[1] * done, 2, *[1] * (4 - done),
    ]
    # The time of the run is that of the first start whose beginning was entered.
    assert len({r["processed_timestamp"] for r in read_table(spark, table).collect()}) == 1


def test_another_version_runs_all_steps(spark, folder):
    first = ingest(spark, folder)
    second = ingest(spark, folder, version="v2", rows=ROWS[:5])
    assert (first.landed_rows, second.landed_rows) == (20, 5)
    assert second.transformed_path != first.transformed_path


def test_a_step_whose_output_is_gone_runs_again(spark, folder):
    first = ingest(spark, folder)
    storage.delete(spark, first.transformed_path)
    again = ingest(spark, folder)
    assert again.landed_path == first.landed_path and again.transformed_path != first.transformed_path
    assert read_parquet(spark, again.aggregated_path).count() == 3
    assert runs(spark, folder)["aggregate"] == (2, 2)


def test_bad_data_is_not_a_finished_step(spark, folder):
    with pytest.raises(ValidationError):
        ingest(spark, folder, rows=[(1, 1, Decimal("-1.00"), T1)])
    assert runs(spark, folder)["land"] == (1, 0)
    assert ingest(spark, folder).landed_rows == 20


def test_a_journal_needs_a_version(spark, folder):
    with pytest.raises(ValueError, match="source_version"):
        ingest(spark, folder, version=None)


def test_the_job_resumes(spark, folder, monkeypatch, capsys):
    source, target = f"s_{uuid.uuid4().hex}", f"t_{uuid.uuid4().hex}"
    replace_table(from_rows(spark, ROWS, schemas.ORDERS), source, f"{folder}/source")
    args = [
        "batch-ingest", source, "--raw", f"{folder}/raw", "--processed", f"{folder}/processed", "--table", target,
        "--table-location", f"{folder}/target", "--journal", f"{folder}/journal", "--source-version", "2024-01-01",
    ]
    with monkeypatch.context() as broken:
        broken.setattr(batch_ingest, "load_table", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.main(args, spark)
    jobs.main(args, spark)
    assert "landed 20 rows" in capsys.readouterr().out and read_table(spark, target).count() == 20
    assert runs(spark, folder)["land"] == (1, 1) and runs(spark, folder)["load"] == (2, 1)


def test_a_csv_flow_goes_on_too(spark, folder):
    """The load fails once; files that came meanwhile are for the next version."""
    with open(f"{folder}/in.csv", "w") as f:
        f.write("a,b\n1,2\n")
    found = []

    def load(frame):
        found.append(sorted(map(tuple, frame.collect())))
        if len(found) == 1:
            raise ConnectionError("the target is away")

    def start(version):
        return run_csv_etl(
            spark, f"{folder}/in.csv", f"{folder}/raw", f"{folder}/out", "web", load, run_ts=datetime(2024, 1, 1 + int(version)),
            journal=f"{folder}/journal", source_version=version,
        )

    with pytest.raises(ConnectionError):
        start("1")
    with open(f"{folder}/in.csv", "w") as f:
        f.write("a,b\n3,4\n")
    start("1")
    assert found == [[("1", "2")]] * 2
    assert runs(spark, folder) == {"begin": (1, 1), "land": (1, 1), "transform": (1, 1), "load": (2, 1)}
    start("2")
    assert found[2] == [("1", "2"), ("3", "4")]
    with pytest.raises(ValueError, match="source_version"):
        run_csv_etl(spark, "x", "y", "z", "n", journal="j")
