"""Datasets at fixed keys, through the Hadoop file system that Spark itself writes with.

A dataset at a key is a row of runs: each run writes a folder of its own below ``<key>.runs``, and an
empty file in the folder ``<key>`` points to the run that counts. Making an empty file is atomic on
every kind of store, and nothing is ever moved, copied or overwritten. So readers see the last
finished run or the new one, whatever the store, and a run that fails leaves nothing behind them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Fixed value: how the pointer files are named, before the number and the run.
POINTER = "_current"
#: Bytes that are read first to find the end of a line; as many as were read before are added then.
_FIRST_BYTES = 1 << 14


def _locate(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _locate(spark, path)
    return fs.delete(p, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Remove ``path`` when the driver ends; it need not exist yet."""
    fs, p = _locate(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file, replacing what is at ``path``."""
    fs, p = _locate(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(data)
    finally:
        stream.close()


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file as a whole."""
    fs, p = _locate(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _locate(spark, path)
    return fs.exists(p)


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file that was not there before, which is atomic on every kind of store."""
    fs, p = _locate(spark, path)
    if not fs.createNewFile(p):
        raise FileExistsError(f"{path} is there already")


def literal(path: str) -> str:
    """A path as Spark's readers take it, where ``*?[]{}`` and a backslash would stand for others."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in path)


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, compressed or not; None if there is none. The rest is not read."""
    fs, p = _locate(spark, path)
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark._jsc.hadoopConfiguration()
    )
    codec, stream = codecs.getCodec(p), fs.open(p)
    try:
        if codec is not None:
            stream = codec.createInputStream(stream)
        data = b""
        while chunk := bytes(stream.readNBytes(max(len(data), _FIRST_BYTES))):
            data += chunk
            line = data.splitlines(keepends=True)[0]
            if len(line) < len(data) or line.endswith(b"\n"):
                data = line
                break
    finally:
        stream.close()
    return data.removeprefix(b"\xef\xbb\xbf").decode("utf-8", "replace").rstrip("\r\n") if data else None


def children(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder, each with the time of its last change; none if there is no folder."""
    fs, p = _locate(spark, folder)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p)}


def has_part_file(spark: SparkSession, path: str) -> bool:
    """Whether an output folder has a part file, without listing all of it."""
    fs, p = _locate(spark, path)
    statuses = fs.listStatusIterator(p)
    while statuses.hasNext():
        if statuses.next().getPath().getName().startswith("part-"):
            return True
    return False


def _pointers(spark: SparkSession, key: str) -> list[tuple[int, str]]:
    """Number and run of the pointers at a key, in their order."""
    names = [n.split(".", 2) for n in children(spark, key) if n.startswith(f"{POINTER}.")]
    return sorted((int(number), run) for _, number, run in names)


def runs_folder(key: str) -> str:
    return f"{key.rstrip('/')}.runs"


def new_run(key: str) -> str:
    """A path for the data of a run that does not count yet."""
    return f"{runs_folder(key)}/{uuid.uuid4().hex}"


def current_run(spark: SparkSession, key: str) -> str | None:
    """Where the data of the run is that counts at a key."""
    pointers = _pointers(spark, key)
    return f"{runs_folder(key)}/{pointers[-1][1]}" if pointers else None


def make_current(spark: SparkSession, key: str, run: str, keep: int = 2) -> None:
    """Point a key to a finished run, then remove all but the last ``keep`` runs.

    Runs that nothing points to were left by drivers that died; they go as well. A key has one
    writer at a time.
    """
    if keep < 1:
        raise ValueError("the run that counts must be kept")
    pointers = _pointers(spark, key)
    name = run.rsplit("/", 1)[1]
    number = pointers[-1][0] + 1 if pointers else 1
    fs, pointer = _locate(spark, f"{key.rstrip('/')}/{POINTER}.{number:020d}.{name}")
    if not fs.createNewFile(pointer):
        raise OSError(f"another run has become number {number} of {key}")
    pointers.append((number, name))
    kept = {r for _, r in pointers[-keep:]}
    for n, r in pointers[:-keep]:
        delete(spark, f"{key.rstrip('/')}/{POINTER}.{n:020d}.{r}")
    for r in children(spark, runs_folder(key)):
        if r not in kept:
            delete(spark, f"{runs_folder(key)}/{r}")
