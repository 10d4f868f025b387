"""Files landed byte for byte."""

import hashlib
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException

from millrace import ledger
from millrace.sinks import broken_ranges, land_bytes, landed_bytes

RUN_TS = datetime(2024, 5, 6, 7, 8, 9)


def put(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, body in files.items():
        with open(f"{folder}/{name}", "wb") as f:
            f.write(body)


def together(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["number"])):
        assert r["start"] == len(found.get(r["file"], b""))
        assert r["sha256"] == hashlib.sha256(bytes(r["body"])).hexdigest()
        found[r["file"]] = found.get(r["file"], b"") + bytes(r["body"])
    return {file.rsplit("/", 1)[1]: body for file, body in found.items()}


FILES = {
    "quoted.csv": b'"a", "b"\r\n"x ""y""", z \r\n',
    "latin.txt": "é;ü\n".encode("latin-1"),
    "bom.txt": b"\xef\xbb\xbfa\nb",
    "zero": b"\x00\xff\x00\n\n\r",
    "empty": b"",
    "name with [odd] {signs} %20.csv": b"1",
    "long": random.Random(1).randbytes(100_003),
}


@pytest.mark.parametrize("range_bytes", [7, 1000, 8 << 20])
def test_any_bytes_come_back(spark, folder, range_bytes):
    files = {k: v[:500] if range_bytes == 7 else v for k, v in FILES.items()}
    put(f"{folder}/in", files)
    path = land_bytes(spark, f"{folder}/in", f"{folder}/raw", "web", RUN_TS, range_bytes)
    assert path.endswith("web_20240506_070809.bytes")
    rows = landed_bytes(spark, f"{folder}/raw", "web").collect()
    assert together(rows) == {name: body for name, body in files.items() if body}
    assert all(r["size"] <= range_bytes and r["run"] == "web_20240506_070809.bytes" for r in rows)
    assert broken_ranges(landed_bytes(spark, f"{folder}/raw", "web")).count() == 0


def test_damage_is_found(spark, folder):
    put(f"{folder}/in", {"a": b"x" * 5000, "b": b"y" * 5000, "c": b"z"})
    land_bytes(spark, f"{folder}/in", f"{folder}/raw", "web", RUN_TS, 1000)
    ranges = landed_bytes(spark, f"{folder}/raw", "web")
    lost = ranges.filter("NOT (file LIKE '%/a' AND number = 2)")
    changed = lost.selectExpr("run", "file", "number", "start", "size", "sha256", "if(file LIKE '%/b' AND number = 3, unhex('00'), body) AS body")
    assert sorted((r["file"][-1], r["damaged"], r["missing_bytes"]) for r in broken_ranges(changed).collect()) == [("a", 0, 1000), ("b", 1, 0)]


def test_only_finished_landings_are_read(spark, folder, monkeypatch):
    put(f"{folder}/in", {"a": b"1"})
    land_bytes(spark, f"{folder}/in", f"{folder}/raw", "web", RUN_TS)
    put(f"{folder}/in", {"a": b"2"})
    with monkeypatch.context() as broken:
        broken.setattr(ledger, "enter", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            land_bytes(spark, f"{folder}/in", f"{folder}/raw", "web", RUN_TS + timedelta(days=1))
    assert together(landed_bytes(spark, f"{folder}/raw", "web").collect()) == {"a": b"1"}
    with pytest.raises(FileNotFoundError):
        landed_bytes(spark, f"{folder}/raw", "other")


def test_files_of_one_name_in_several_folders(spark, folder):
    put(f"{folder}/in/x", {"a": b"1"})
    put(f"{folder}/in/y", {"a": b"2"})
    land_bytes(spark, [f"{folder}/in/x", f"{folder}/in/y"], f"{folder}/raw", "web", RUN_TS)
    found = landed_bytes(spark, f"{folder}/raw", "web").collect()
    assert sorted((r["file"][-3:], bytes(r["body"])) for r in found) == [("x/a", b"1"), ("y/a", b"2")]
    with pytest.raises(PySparkException):
        land_bytes(spark, f"{folder}/none", f"{folder}/raw", "web", RUN_TS)


def test_a_large_file_is_landed_by_many_tasks(spark, folder):
    put(f"{folder}/in", {"big": random.Random(2).randbytes(1 << 20)})
    path = land_bytes(spark, f"{folder}/in", f"{folder}/raw", "web", RUN_TS, 4096)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) >= 16
    (run,) = ledger.finished_runs(spark, f"{folder}/raw", "web")
    assert run.rows == 256


@pytest.mark.parametrize("range_bytes", [3, 100, 4096, 1 << 20])
def test_parts_of_a_folder_are_landed_as_one_file(spark, folder, range_bytes):
    sizes = {"a": [5, 0, 1, 300, 2], "b%20 c": [4096], "d": [1] * 20}
    bodies = {name: [random.Random(i).randbytes(n) for i, n in enumerate(s)] for name, s in sizes.items()}
    for name, parts in bodies.items():
        put(f"{folder}/in/{name}", {f"part-{i:05d}": body for i, body in enumerate(parts)})
    land_bytes(spark, f"{folder}/in", f"{folder}/raw", "web", RUN_TS, range_bytes, join_parts=True)
    rows = landed_bytes(spark, f"{folder}/raw", "web").collect()
    assert together(rows) == {name: b"".join(parts) for name, parts in bodies.items()}
    whole = {name: sum(s) for name, s in sizes.items()}
    assert len(rows) == sum(-(-n // range_bytes) for n in whole.values()) and all(r["size"] <= range_bytes for r in rows)
    assert broken_ranges(landed_bytes(spark, f"{folder}/raw", "web")).count() == 0
