"""Removes long word spans that occur earlier in the corpus, over a de Bruijn graph of tokens.

The runs of ``window`` words are the edges of the graph. A repeated span is a path of edges that
have an earlier occurrence.

Most edges occur once and must not travel. Each edge has an anchor: the smallest hash of the
k-grams in it. Equal edges have equal anchors, and about one word in six begins an anchor. A first
round joins the anchors of all texts: which are repeated, and whether all occurrences of one go
on to the same next anchor, over the same words, and come from the same one before. Where both ends
of a step say so it does not branch, and steps in a row compact into a path: each of its edges
occurs where the path does, and nowhere else.

Only what is near a repeated anchor enters the second round: a path as one entry, and edges that
lie in no path one by one. There the first occurrence of each is found by source coordinates (document
and position), and equality is verified by a hash of all its words. Joined back to their texts, later
occurrences become maximal spans, whose words go.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from millrace.llm import grouped
from millrace.llm.grouped import Group
from millrace.llm.tokens import Rolling, Words, covered, minimizers, mix, sliding_min, words

_NEVER = np.uint64(2**64 - 1)
_EDGE = ["u8", "u4", "i8", "i8", "i4"]  # hash, check, document, hash of its text, position


#: What a part says of an anchor.
_REPEATED, _ONE_NEXT, _ONE_BEFORE = 1, 2, 4
#: What a group says of one: that it is there more than once, and that its steps differ.
_MANY, _NEXT_DIFFERS, _BEFORE_DIFFERS = 1, 2, 4
_ANCHOR = ["u4", "u1", "u4", "u2", "u4", "u2"]  # key, marks, step to the next, step from the one before


def _differs(order: np.ndarray, new: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each run of equal keys whether the values differ. ``order`` sorts keys, ``new`` begins runs."""
    run = np.cumsum(new) - 1
    other = values[order] != values[order[new]][run]
    return np.bincount(run, other, int(new.sum())) > 0


class _Edges:
    """Anchors of a group's texts, and the paths and edges near those that are repeated."""

    def __init__(self, group: Group, window: int, anchor: int) -> None:
        self.window, self.anchor = window, anchor
        self.slices = list(words(group.texts))
        self.places: list[np.ndarray] = []
        keys, after, before = [], [], []
        for w in self.slices:
            grams = self._grams(w)
            at = minimizers(grams, window - anchor + 1)
            at = at[grams[at] != _NEVER]
            # The words of a step, both anchors among them, by which it is known; 0 where there is none.
            step = np.zeros(len(at) + 1, dtype=np.uint64)
            within = np.flatnonzero(w.text_of[at[1:]] == w.text_of[at[:-1]]) if len(at) else at
            step[within + 1] = w.rolling.runs(at[within], at[within + 1] + anchor) | np.uint64(1)
            self.places.append(at)
            keys.append(grams[at])
            after.append(step[1:])
            before.append(step[:-1])
        none = [np.zeros(0, np.uint64)]
        keys, after, before = (np.concatenate(x or none) for x in (keys, after, before))
        order = np.argsort(keys, kind="stable")
        new = np.diff(keys[order], prepend=~keys[order[:1]]) != 0
        first = order[new]
        self.anchors, self.after, self.before = keys[first], after[first], before[first]
        self.marks = (
            _MANY * (np.bincount(np.cumsum(new) - 1, minlength=len(first)) > 1)
            + _NEXT_DIFFERS * _differs(order, new, after)
            + _BEFORE_DIFFERS * _differs(order, new, before)
        ).astype(np.uint8)

    def _grams(self, w: Words) -> np.ndarray:
        n = len(w.starts) - self.anchor + 1
        return np.where(w.whole(self.anchor), w.rolling.grams(self.anchor), _NEVER) if n > 0 else np.zeros(0, np.uint64)

    def sent(self) -> list[np.ndarray]:
        """The columns of ``_ANCHOR``: 32 bits of each key (a chance match only makes a step branch, or
        sends an edge in vain), 48 bits of each step."""
        columns = [(self.anchors >> np.uint64(32)).astype(np.uint32), self.marks]
        for step in (self.after, self.before):
            columns += [(step & np.uint64(0xFFFFFFFF)).astype(np.uint32), (step >> np.uint64(48)).astype(np.uint16)]
        return columns

    def _paths(self, w: Words, at: np.ndarray, said: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends, in words, of the paths that have an edge."""
        joined = (w.text_of[at[1:]] == w.text_of[at[:-1]]) & (said[:-1] & _ONE_NEXT > 0) & (said[1:] & _ONE_BEFORE > 0)
        joined &= (said[:-1] & said[1:] & _REPEATED) > 0
        change = np.diff(joined.astype(np.int8), prepend=0, append=0)
        starts, ends = at[np.flatnonzero(change == 1)], at[np.flatnonzero(change == -1)] + self.anchor
        long = ends - starts >= self.window
        return starts[long], ends[long]

    def candidates(self, said: np.ndarray) -> tuple[np.ndarray, ...]:
        """Slice, start in it, number of edges, text, position in the text, hash and check of the
        paths and of the other edges. ``said`` is what the parts say of the group's anchors."""
        keys = self.anchors[said & _REPEATED > 0]
        out = []
        for k, (w, at) in enumerate(zip(self.slices, self.places, strict=True)):
            if not len(at) or not len(keys):
                continue
            grams = self._grams(w)
            lowest = sliding_min(grams, self.window - self.anchor + 1)
            runs = np.flatnonzero(np.diff(lowest, prepend=~lowest[:1]))
            hit = keys[np.minimum(np.searchsorted(keys, lowest[runs]), len(keys) - 1)] == lowest[runs]
            alone = np.repeat(hit, np.diff(np.append(runs, len(lowest)))) & w.whole(self.window)
            starts, ends = self._paths(w, at, said[np.searchsorted(self.anchors, grams[at])])
            in_paths = ends - starts - self.window + 1
            alone &= ~covered(len(alone), starts, in_paths)
            single = np.flatnonzero(alone)
            start = np.concatenate([single, starts])
            end = np.concatenate([single + self.window, ends])
            edges = np.concatenate([np.ones(len(single), np.int64), in_paths])
            # Hashes hold the number of edges, so that a path is no edge.
            salt = mix(edges.astype(np.uint64))
            check = Rolling(mix(w.hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))).runs(start, end)
            text = w.text_of[start]
            out.append(
                (
                    np.full(len(start), k),
                    start,
                    edges,
                    w.first_row + text,
                    start - w.of_text[text],
                    mix(w.rolling.runs(start, end) ^ salt),
                    (check >> np.uint64(32)).astype(np.uint32),
                )
            )
        if not out:
            return tuple(np.zeros(0, t) for t in ("i8", "i8", "i8", "i8", "i8", "u8", "u4"))
        found = [np.concatenate(c) for c in zip(*out, strict=True)]
        order = np.lexsort((found[4], found[3]))  # by source: text, then position
        return tuple(c[order] for c in found)


def _first_of_each(edge: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries that come first among equal ones, and for each entry its place among those.

    Entries come in source order.
    """
    order = np.lexsort((np.arange(len(edge)), check, edge))
    new = np.ones(len(edge), dtype=bool)
    new[1:] = (edge[order[1:]] != edge[order[:-1]]) | (check[order[1:]] != check[order[:-1]])
    place = np.empty(len(edge), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], place


def remove_repeats(
    docs: DataFrame,
    window: int = 20,
    anchor: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    with_text: bool = False,
    group_bytes: int | None = None,
) -> DataFrame:
    """A row per row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``spans``.

    A word goes if it lies in a run of ``window`` words of one document that also starts earlier:
    in a document of a smaller id, or earlier in the same one. All is judged on the input.
    ``kept_sha256`` is the hex digest of the kept words joined by blanks, ``spans`` has the first
    word and the end of each removed path. ``with_text`` adds ``kept_text`` (the kept words, or the
    text as it is if nothing goes) and the input row without its text as a struct ``row``.

    Null and empty texts have no words. Null ids come after all others. Rows that repeat id and
    text are one document and get the same result; texts that share an id are documents of their
    own, in the order of a hash of the text. An empty table gives an empty result. Words are told
    apart by 64-bit hashes, paths and edges by 96 bits. A text is held in memory whole.
    """
    texts, groups = grouped.deal(docs, doc_id, text, group_bytes, rows=with_text)
    anchor_parts, edge_parts = max(1, groups // 4), max(1, groups // 4)

    def send_anchors(g: int, group: Group, _: dict) -> pa.Table:
        edges = _Edges(group, window, anchor)
        part = (edges.anchors % np.uint64(anchor_parts)).astype(np.int64)
        return grouped.to_parts(g, part, edges.sent())

    def reply_anchors(table: pa.Table) -> pa.Table:
        (keys, marks, *steps), came_in = grouped.gather(table, _ANCHOR)
        order = np.argsort(keys, kind="stable")
        new = np.diff(keys[order], prepend=~keys[order[:1]]) != 0
        run = np.cumsum(new) - 1
        has = lambda mark: np.bincount(run, marks[order] & mark) > 0
        said = _REPEATED * (has(_MANY) | (np.bincount(run) > 1))
        for bit, mark, step in ((_ONE_NEXT, _NEXT_DIFFERS, steps[:2]), (_ONE_BEFORE, _BEFORE_DIFFERS, steps[2:])):
            said = said + bit * ~(has(mark) | _differs(order, new, step[0]) | _differs(order, new, step[1]))
        values = np.empty(len(keys), dtype=np.uint8)
        values[order] = np.where(said & _REPEATED, said, 0)[run]
        return grouped.answer(table, came_in, values)

    def known(group: Group, answers: dict[int, pa.Table]) -> tuple[_Edges, tuple, np.ndarray, np.ndarray]:
        edges = _Edges(group, window, anchor)
        said = np.zeros(len(edges.anchors), dtype=np.uint8)
        if 1 in answers:
            part = (edges.anchors % np.uint64(anchor_parts)).astype(np.int64)
            said = grouped.from_parts(answers[1], part, "u1")
        found = edges.candidates(said)
        return edges, found, *_first_of_each(found[5], found[6])

    def send_edges(g: int, group: Group, answers: dict[int, pa.Table]) -> pa.Table:
        _, (_, _, _, text_no, start, edge, check), first, _ = known(group, answers)
        part = (edge[first] % np.uint64(edge_parts)).astype(np.int64)
        who = text_no[first]
        return grouped.to_parts(
            g, part, [edge[first], check[first], group.ids[who], group.tkeys[who], start[first].astype(np.int32)]
        )

    def reply_later(table: pa.Table) -> pa.Table:
        (edge, check, ids, tkeys, start), came_in = grouped.gather(table, _EDGE)
        order = np.lexsort((start, tkeys, ids, check, edge))
        later = np.zeros(len(edge), dtype=np.uint8)
        later[order[1:]] = (edge[order[1:]] == edge[order[:-1]]) & (check[order[1:]] == check[order[:-1]])
        return grouped.answer(table, came_in, later)

    spans_type = T.ArrayType(T.StructType().add("start", "long").add("end", "long"))
    schema = T.StructType().add("doc_id", "long").add("n_words", "long").add("n_removed", "long")
    schema = schema.add("kept_sha256", "string").add("spans", spans_type)
    if with_text:
        schema = schema.add("kept_text", "string").add("row", texts.schema["row"].dataType)

    def remove(_: int, group: Group, answers: dict[int, pa.Table]) -> pa.Table:
        edges, (slice_no, at, n_edges, _, _, edge, _), first, place = known(group, answers)
        repeats = np.ones(len(edge), dtype=bool)
        repeats[first] = False
        if 2 in answers:
            part = (edge[first] % np.uint64(edge_parts)).astype(np.int64)
            repeats |= grouped.from_parts(answers[2], part, "u1").astype(bool)[place]
        results: list[dict] = []
        for k, w in enumerate(edges.slices):
            later = repeats & (slice_no == k)
            gone = covered(len(w.starts), at[later], n_edges[later] + window - 1)
            body = w.data.tobytes()
            firsts, lasts = w.starts.tolist(), w.ends.tolist()
            for i in range(len(w.counts)):
                a, b = int(w.of_text[i]), int(w.of_text[i + 1])
                change = np.flatnonzero(np.diff(gone[a:b], prepend=False, append=False)).tolist()
                kept = b" ".join([body[firsts[j] : lasts[j]] for j in (np.flatnonzero(~gone[a:b]) + a).tolist()])
                results.append(
                    {
                        "n_words": b - a,
                        "n_removed": int(gone[a:b].sum()),
                        "kept_sha256": hashlib.sha256(kept).hexdigest(),
                        "spans": [{"start": x, "end": y} for x, y in zip(change[::2], change[1::2], strict=True)],
                    }
                    | ({"kept_text": kept if change else body[w.offsets[i] : w.offsets[i + 1]]} if with_text else {})
                )
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "spans": spans}
        columns = {c: pa.array([r[c] for r in results], t) for c, t in kinds.items()}
        if with_text:
            columns["kept_text"] = pa.array([r["kept_text"] for r in results], pa.binary()).cast(pa.string())
        out = pa.table(columns).take(pa.array(group.text_of_row))
        out = out.add_column(0, "doc_id", group.table["doc_id"])
        return out.append_column("row", group.table["row"]) if with_text else out

    first = grouped.as_round(grouped.ask(texts, send_anchors, reply_anchors), 1)
    second = grouped.as_round(grouped.ask(texts, send_edges, reply_later, first), 2)
    return grouped.with_answers(texts, first.unionAll(second), remove, schema)
