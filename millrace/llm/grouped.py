"""Groups of texts that exchange packed keys.

Texts are dealt to groups of a few megabytes by a hash. A group sends the keys it has to parts,
packed: one row has all keys of one group for one part. A part answers each such row with a
value for each of its keys, in the same order. The group works out its keys again when
the answer comes, so neither positions nor texts travel with them.

Groups and parts grow in number with the data; their size grows only with its root, and only up to
eightfold, so that the rows they exchange do not become too many and too small. Before it sends, a group drops all
but the first of equal keys, so that a key which is everywhere comes to its part once a group.
All rounds of one query are one plan, in which the shuffle of the texts is done once and reused.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.functions import quoted

GROUP_BYTES = 4 << 20
#: From so many bytes of text on groups grow.
_LARGE = 64 << 30
NO_ID = np.iinfo(np.int64).max
PACKED = "part int, g int, packed binary"


def deal(
    docs: DataFrame, doc_id: str, text: str, group_bytes: int | None = None, rows: bool = False
) -> tuple[DataFrame, int]:
    """``g``, ``doc_id``, ``tkey`` (a hash of the text), ``text`` as bytes, and the number of groups.

    Null texts are empty. ``rows`` adds the input row without its text as a struct ``row``.
    """
    body = F.coalesce(quoted(text).cast("binary"), F.lit(b""))
    size = docs.agg(F.sum(F.octet_length(body).cast("long") + 64)).first()[0] or 0
    if group_bytes is None:
        group_bytes = int(GROUP_BYTES * min(8.0, max(1.0, (size / _LARGE) ** 0.5)))
    groups = max(1, -(-size // group_bytes))
    tkey = F.xxhash64(body)
    others = [quoted(c) for c in docs.columns if c != text]
    dealt = docs.select(
        F.expr("0").alias("g"),
        quoted(doc_id).cast("long").alias("doc_id"),
        tkey.alias("tkey"),
        body.alias("text"),
        *([F.struct(*others).alias("row")] if rows else []),
    )
    return dealt.withColumn("g", F.pmod(F.xxhash64("doc_id", "tkey"), F.lit(groups)).cast("int")), groups


class Group:
    """A group's texts in a fixed order, each row that repeats id and text once."""

    def __init__(self, table: pa.Table) -> None:
        table = table.sort_by([("doc_id", "ascending"), ("tkey", "ascending")])
        self.table = table
        ids = table["doc_id"].fill_null(NO_ID).to_numpy()
        tkeys = table["tkey"].to_numpy()
        new = np.ones(len(ids), dtype=bool)
        new[1:] = (ids[1:] != ids[:-1]) | (tkeys[1:] != tkeys[:-1])
        #: The text of each row of the table.
        self.text_of_row = np.cumsum(new) - 1
        self.ids, self.tkeys = ids[new], tkeys[new]
        self.texts = table["text"].filter(pa.array(new))


def pack(arrays: list[np.ndarray]) -> bytes:
    """Columns of one length, one after the other."""
    return zstandard.compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), 1)


def unpack(body: bytes, kinds: list[str]) -> list[np.ndarray]:
    raw = zstandard.decompress(body)
    width = sum(np.dtype(k).itemsize for k in kinds)
    n, out, at = len(raw) // width, [], 0
    for kind in kinds:
        out.append(np.frombuffer(raw, dtype=kind, count=n, offset=at))
        at += n * np.dtype(kind).itemsize
    return out


def to_parts(g: int, part: np.ndarray, columns: list[np.ndarray]) -> pa.Table:
    """A packed row for each part. Entries keep their order within a part."""
    order = np.argsort(part, kind="stable")
    bounds = np.flatnonzero(np.diff(part[order], prepend=-1))
    ends = np.append(bounds, len(order))[1:]
    rows = [pack([c[order[a:b]] for c in columns]) for a, b in zip(bounds, ends, strict=True)]
    parts = part[order[bounds]].astype(np.int32)
    return pa.table(
        {"part": pa.array(parts), "g": pa.array([g] * len(rows), pa.int32()), "packed": pa.array(rows, pa.binary())}
    )


def from_parts(answers: pa.Table, part: np.ndarray, kind: str) -> np.ndarray:
    """The answers to what ``to_parts`` sent, in the order of its entries; zero where none came."""
    out = np.zeros(len(part), dtype=kind)
    order = np.argsort(part, kind="stable")
    sorted_parts = part[order]
    for p, body in zip(answers["part"].to_pylist(), answers["packed"].to_pylist(), strict=True):
        a, b = np.searchsorted(sorted_parts, [p, p + 1])
        out[order[a:b]] = unpack(body, [kind])[0]
    return out


def gather(table: pa.Table, kinds: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """All entries that came to a part, column by column, and the row that each came in."""
    rows = [unpack(body, kinds) for body in table["packed"].to_pylist()]
    columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
    return columns, np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])


def answer(table: pa.Table, came_in: np.ndarray, values: np.ndarray) -> pa.Table:
    """A row for each row that came in and has some value other than zero."""
    bounds = np.searchsorted(came_in, np.arange(table.num_rows + 1))
    some = [i for i in range(table.num_rows) if values[bounds[i] : bounds[i + 1]].any()]
    bodies = [pack([values[bounds[i] : bounds[i + 1]]]) for i in some]
    picked = table.select(["part", "g"]).take(pa.array(some, pa.int64()))
    return picked.append_column("packed", pa.array(bodies, pa.binary()))


def ask(
    texts: DataFrame,
    send: Callable[[int, Group, dict[int, pa.Table]], pa.Table],
    reply: Callable[[pa.Table], pa.Table],
    answers: DataFrame | None = None,
) -> DataFrame:
    """One round: groups send, parts reply. ``answers`` are those of the rounds before."""
    if answers is None:
        sent = texts.groupBy("g").applyInArrow(
            lambda table: send(table["g"][0].as_py(), Group(table), {}), PACKED
        )
    else:
        sent = with_answers(texts, answers, send, PACKED)
    return sent.groupBy("part").applyInArrow(reply, PACKED)


def with_answers(
    texts: DataFrame,
    answers: DataFrame,
    act: Callable[[int, Group, dict[int, pa.Table]], pa.Table],
    schema: str | T.StructType,
) -> DataFrame:
    """``act`` on every group that has texts, with the answers it got, by round."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            raise ValueError("answers came for a group without texts")
        rounds = right["round"].to_numpy()
        by_round = {int(r): right.filter(pa.array(rounds == r)) for r in np.unique(rounds)}
        return act(left["g"][0].as_py(), Group(left), by_round)

    return texts.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(run, schema)


def as_round(answers: DataFrame, number: int) -> DataFrame:
    return answers.select("g", F.lit(number).alias("round"), "part", "packed")
