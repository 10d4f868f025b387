"""Removes long byte strings that earlier documents have, with a logarithmic family of suffix arrays.

Of all suffixes only those that start with an anchor are dealt out: an anchor is the smallest
hash among the ``anchor``-byte strings of some ``length`` bytes, so every string of ``length``
bytes holds one, and equal strings hold it at the same place. A first round finds the anchors that
occur in several groups of documents or more than once in one. In a second round their
surroundings, all bytes that a string around them can have, go to the part of the index that
the anchor's hash names. Where an anchor occurs in very many groups, as a common phrase does, no part
takes all its surroundings: its strings are dealt out one by one, each by its own fingerprint.

A part takes the suffixes in batches of rising document ids. Those of a batch are sorted into a
suffix array (by the fingerprint of their first ``length`` bytes, so that equal starts are
neighbours), and the array is merge-scanned against each level of the index: what is found there
starts in an earlier document. Then it joins the index as a new level, and levels of the same size
class merge, so that there are few levels and each suffix is merged a logarithmic number of times.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import grouped
from millrace.llm.grouped import Group
from millrace.llm.tokens import _VALUES, Rolling, covered, minimizers, mix, text_slices

_NEVER = np.uint64(2**64 - 1)
#: Contexts whose strings are worked out at a time.
_CONTEXTS = 1 << 12


class IndexFamily:
    """Levels of sorted fingerprints, each with the smallest document that has it.

    Batches must come in the order of their documents. Levels are of falling size; two neighbours
    of which the upper is at least half as large are merged.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def scan(self, keys: np.ndarray) -> np.ndarray:
        """The smallest document that has each of the sorted keys, or ``NO_ID``."""
        low = np.full(len(keys), grouped.NO_ID)
        for level, documents in self.levels:
            at = np.minimum(np.searchsorted(level, keys), len(level) - 1)
            found = level[at] == keys
            low[found] = np.minimum(low[found], documents[at[found]])
        return low

    def add(self, keys: np.ndarray, documents: np.ndarray) -> None:
        """Adds distinct sorted keys as a level."""
        if not len(keys):
            return
        self.levels.append((keys, documents))
        while len(self.levels) > 1 and 2 * len(self.levels[-1][0]) >= len(self.levels[-2][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            keys, documents = np.concatenate([a, b]), np.concatenate([x, y])
            order = np.argsort(keys, kind="stable")  # merges two sorted runs
            keys, documents = keys[order], documents[order]
            first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
            self.levels.append((keys[first], np.minimum.reduceat(documents, first)))


def match_batches(keys: np.ndarray, documents: np.ndarray, batch_rows: int = 1 << 17) -> np.ndarray:
    """For each suffix whether a smaller document has one of the same key.

    Suffixes come in the order of their documents. A batch ends where a document ends.
    """
    family, out, at = IndexFamily(), np.zeros(len(keys), dtype=bool), 0
    while at < len(keys):
        end = min(at + batch_rows, len(keys))
        end = int(np.searchsorted(documents, documents[end - 1], side="right"))
        order = np.argsort(keys[at:end], kind="stable")  # the batch's suffix array
        sorted_keys, owners = keys[at:end][order], documents[at:end][order]
        first = np.flatnonzero(np.diff(sorted_keys, prepend=~sorted_keys[:1]))
        low = np.minimum.reduceat(owners, first)
        before = np.minimum(family.scan(sorted_keys[first]), low)
        out[at + order] = np.repeat(before, np.diff(np.append(first, len(order)))) < owners
        family.add(sorted_keys[first], low)
        at = end
    return out


class _Suffixes:
    """Anchors of a group's texts, and the surroundings of those that are repeated."""

    def __init__(self, group: Group, length: int, anchor: int) -> None:
        self.group, self.length, self.anchor = group, length, anchor
        self.slices = list(text_slices(group.texts))
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        for _, offsets, data in self.slices:
            n = len(data) - anchor + 1
            if n <= 0:
                self.found.append((np.zeros(0, np.int64), np.zeros(0, np.uint64)))
                continue
            grams = Rolling(_VALUES[data]).grams(anchor)
            inside = np.ones(n + anchor, dtype=bool)
            for cut in offsets[1:-1].tolist():  # strings across a border of texts are none
                inside[max(0, cut - anchor + 1) : cut] = False
            grams[~inside[:n]] = _NEVER
            at = minimizers(grams, length - anchor + 1)
            at = at[grams[at] != _NEVER]
            self.found.append((at, grams[at]))
        keys = np.concatenate([k for _, k in self.found]) if self.found else np.zeros(0, np.uint64)
        self.keys, counts = np.unique(keys, return_counts=True)
        self.many = counts > 1

    def contexts(self, said: np.ndarray) -> dict[str, np.ndarray]:
        """The surroundings of each repeated anchor, zeros beyond the ends of its text.

        ``slice``, ``at``: where it is; ``text``: whose it is; ``key``; ``said``: what its part says of
        it; ``low`` and ``high``: how many bytes before the anchor a string within the text may
        start, at least and at most.
        """
        keys, said = self.keys[said > 0], said[said > 0]
        reach = self.length - self.anchor
        out: list[tuple[np.ndarray, ...]] = []
        for k, ((row, offsets, data), (at, found)) in enumerate(zip(self.slices, self.found, strict=True)):
            if not len(keys) or not len(at):
                continue
            where = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            hit = keys[where] == found
            at, found, of_part = at[hit], found[hit], said[where[hit]]
            text = np.searchsorted(offsets, at, side="right") - 1
            high = np.minimum(at - offsets[text], reach)
            low = np.maximum(0, at + self.length - offsets[text + 1])
            fits = low <= high
            at, found, of_part = at[fits], found[fits], of_part[fits]
            text, low, high = text[fits], low[fits], high[fits]
            padded = np.concatenate([np.zeros(reach, np.uint8), data, np.zeros(self.length, np.uint8)])
            around = np.lib.stride_tricks.sliding_window_view(padded, reach + self.length)[at].copy()
            place = np.arange(reach + self.length) - reach
            around[(place < -high[:, None]) | (place >= (offsets[text + 1] - at)[:, None])] = 0
            out.append((np.full(len(at), k), at, row + text, found, of_part, low, high, around))
        names = ("slice", "at", "text", "key", "said", "low", "high", "around")
        if not out:
            kinds = ("i8", "i8", "i8", "u8", "u1", "i8", "i8")
            empty = [np.zeros(0, t) for t in kinds] + [np.zeros((0, reach + self.length), np.uint8)]
            return dict(zip(names, empty, strict=True))
        return {n: np.concatenate(c) for n, c in zip(names, zip(*out, strict=True), strict=True)}


#: What a part says of an anchor: that it is repeated, and that it is in very many groups.
_REPEATED, _COMMON = 1, 2


def _hashes_of_rows(around: np.ndarray) -> np.ndarray:
    n, width = around.shape
    every = Rolling(_VALUES[around.ravel()])
    starts = np.arange(n) * width
    return every.runs(starts, starts + width)


def remove_earlier_strings(
    docs: DataFrame,
    length: int = 50,
    anchor: int = 24,
    doc_id: str = "doc_id",
    text: str = "text",
    with_text: bool = False,
    group_bytes: int | None = None,
    common_groups: int = 512,
) -> DataFrame:
    """A row per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``.

    A byte of the UTF-8 text goes if a string of ``length`` bytes around it also starts in a
    document of a smaller id. All is judged on the input. ``kept_sha256`` is the hex digest of the
    other bytes. ``with_text`` adds them as a column ``kept`` (binary).

    Null and empty texts have no bytes. Null ids count as the greatest. Rows that share an id are not
    earlier than each other, and each is judged by itself. An empty table gives an empty result.
    Strings are told apart by 64-bit hashes besides their anchor's, or by 96 bits for anchors in
    ``common_groups`` groups or more. A text is held in memory whole.
    """
    texts, groups = grouped.deal(docs, doc_id, text, group_bytes)
    anchor_parts, parts = max(1, groups // 8), groups
    width = 2 * length - anchor
    reach = length - anchor

    whole = np.uint32((1 << (reach + 1)) - 1)

    def marks_of(around: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Hashes of surroundings; the bounds tell zeros of a text from those beyond its ends."""
        bounds = low.astype(np.uint64) * np.uint64(256) + high.astype(np.uint64)
        blocks = [_hashes_of_rows(around[i : i + _CONTEXTS]) for i in range(0, len(around), _CONTEXTS)]
        return mix(np.concatenate([np.zeros(0, np.uint64), *blocks]) ^ bounds)

    def send_anchors(g: int, group: Group, _: dict) -> pa.Table:
        suffixes = _Suffixes(group, length, anchor)
        part = (suffixes.keys % np.uint64(anchor_parts)).astype(np.int64)
        short = (suffixes.keys >> np.uint64(32)).astype(np.uint32)
        return grouped.to_parts(g, part, [short, suffixes.many.astype(np.uint8)])

    def reply_repeated(table: pa.Table) -> pa.Table:
        (keys, many), came_in = grouped.gather(table, ["u4", "u1"])
        order = np.argsort(keys, kind="stable")
        run = np.cumsum(np.diff(keys[order], prepend=~keys[order[:1]]) != 0) - 1
        n = np.bincount(run)
        said = np.where((n > 1) | (np.bincount(run, many[order]) > 0), _REPEATED, 0)
        said += np.where((said > 0) & (n >= common_groups), _COMMON, 0)
        values = np.empty(len(keys), dtype=np.uint8)
        values[order] = said[run]
        return grouped.answer(table, came_in, values)

    def known(group: Group, answers: dict[int, pa.Table]) -> tuple[_Suffixes, dict, np.ndarray, np.ndarray, dict]:
        """The group's suffixes; surroundings of repeated anchors; of equal ones that of the first
        document, and for each its kind among those; the strings of the kinds around common anchors."""
        suffixes = _Suffixes(group, length, anchor)
        said = np.zeros(len(suffixes.keys), dtype=np.uint8)
        if 1 in answers:
            part = (suffixes.keys % np.uint64(anchor_parts)).astype(np.int64)
            said = grouped.from_parts(answers[1], part, "u1")
        found = suffixes.contexts(said)
        marks = marks_of(found["around"], found["low"], found["high"])
        _, first, place = np.unique(marks, return_index=True, return_inverse=True)
        return suffixes, found, first, place, strings_of(found, first, group)

    def strings_of(found: dict, first: np.ndarray, group: Group) -> dict[str, np.ndarray]:
        """The strings around common anchors: ``kind`` and ``before`` say which, ``id`` whose; ``one``
        has one of each, of its first document, with ``hash`` and ``check``; ``place`` says which is each."""
        kinds = np.flatnonzero(found["said"][first] & _COMMON)
        out: list[tuple[np.ndarray, ...]] = []
        for i in range(0, len(kinds), _CONTEXTS):
            kind = kinds[i : i + _CONTEXTS]
            some = first[kind]
            low, high, owners = found["low"][some], found["high"][some], group.ids[found["text"][some]]
            values = _VALUES[found["around"][some].ravel()]
            every, other = Rolling(values), Rolling(mix(values))
            base = np.arange(len(some)) * width
            for before in range(reach + 1):
                ok = np.flatnonzero((low <= before) & (before <= high))
                start = base[ok] + reach - before
                check = (other.runs(start, start + length) >> np.uint64(32)).astype(np.uint32)
                back = np.full(len(ok), before, dtype=np.uint8)
                out.append((kind[ok].astype(np.int32), back, owners[ok], every.runs(start, start + length), check))
        names, types = ("kind", "before", "id", "hash", "check"), ("i4", "u1", "i8", "u8", "u4")
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, t) for t in types]
        strings = dict(zip(names, columns, strict=True))
        order = np.lexsort((strings["id"], strings["check"], strings["hash"]))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(strings["hash"][order]) != 0) | (np.diff(strings["check"][order]) != 0)
        place = np.empty(len(order), dtype=np.int32)
        place[order] = np.cumsum(new) - 1
        return strings | {"one": order[new], "place": place}

    def string_part(strings: dict) -> np.ndarray:
        return parts + (strings["hash"][strings["one"]] % np.uint64(parts)).astype(np.int64)

    def of_strings(answers: pa.Table, yes: bool) -> pa.Table:
        return answers.filter(pa.array((answers["part"].to_numpy() >= parts) == yes))

    def part_of(found: dict, first: np.ndarray) -> np.ndarray:
        return (found["key"][first] % np.uint64(parts)).astype(np.int64)

    def send_contexts(g: int, group: Group, answers: dict[int, pa.Table]) -> pa.Table:
        _, found, first, _, strings = known(group, answers)
        first, one = first[found["said"][first] & _COMMON == 0], strings["one"]
        columns = [
            found["key"][first],
            group.ids[found["text"][first]],
            found["low"][first].astype(np.uint8),
            found["high"][first].astype(np.uint8),
            found["around"][first].view(f"V{width}").ravel() if len(first) else np.zeros(0, f"V{width}"),
        ]
        sent = grouped.to_parts(g, part_of(found, first), columns)
        columns = [strings["hash"][one], strings["check"][one], strings["id"][one]]
        return pa.concat_tables([sent, grouped.to_parts(g, string_part(strings), columns)])

    def reply_strings(table: pa.Table) -> pa.Table:
        (hashes, check, ids), came_in = grouped.gather(table, ["u8", "u4", "i8"])
        order = np.lexsort((ids, check, hashes))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(hashes[order]) != 0) | (np.diff(check[order]) != 0)
        later = np.zeros(len(order), dtype=np.uint8)
        later[order] = ids[order] > ids[order[new]][np.cumsum(new) - 1]
        return grouped.answer(table, came_in, later)

    def reply_matches(table: pa.Table) -> pa.Table:
        if table["part"][0].as_py() >= parts:
            return reply_strings(table)
        columns, came_in = grouped.gather(table, ["u8", "i8", "u1", "u1", f"V{width}"])
        key, ids, low, high, packed = columns
        around = packed.view(np.uint8).reshape(-1, width)
        marks = marks_of(around, low, high)
        # What has the same surroundings in an earlier document is found whole. Of equal ones the
        # first stands for all, and where an anchor has but one kind there is nothing else to find.
        order = np.lexsort((ids, marks, key))
        new_key = np.diff(key[order], prepend=~key[order[:1]]) != 0
        new_kind = new_key | (np.diff(marks[order], prepend=~marks[order[:1]]) != 0)
        kind = np.cumsum(new_kind) - 1
        masks = np.zeros(len(key), dtype=np.uint32)
        of_key = np.cumsum(new_key[new_kind]) - 1
        several = np.bincount(of_key)[of_key] > 1
        firsts = order[new_kind][several]
        firsts = firsts[np.argsort(ids[firsts], kind="stable")]
        hashes, rows, offsets = [], [], []
        for at in range(0, len(firsts), _CONTEXTS):
            some = firsts[at : at + _CONTEXTS]
            every = Rolling(_VALUES[around[some].ravel()])
            base = np.arange(len(some)) * width
            for before in range(reach + 1):  # the string that starts so many bytes before the anchor
                ok = np.flatnonzero((low[some] <= before) & (before <= high[some]))
                start = base[ok] + reach - before
                # Equal strings have equal anchors, so the anchor's hash tells strings apart as well.
                hashes.append(mix(every.runs(start, start + length) ^ mix(key[some[ok]] + np.uint64(before))))
                rows.append(some[ok])
                offsets.append(np.full(len(ok), before, dtype=np.uint8))
        if hashes:
            hashes, rows, offsets = np.concatenate(hashes), np.concatenate(rows), np.concatenate(offsets)
            by_document = np.argsort(ids[rows], kind="stable")
            hit = by_document[match_batches(hashes[by_document], ids[rows[by_document]])]
            np.bitwise_or.at(masks, rows[hit], np.uint32(1) << offsets[hit].astype(np.uint32))
        first = order[new_kind][kind]
        masks[order] = np.where(ids[order] > ids[first], whole, masks[first])
        return grouped.answer(table, came_in, masks)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept binary" if with_text else ""

    def remove(_: int, group: Group, answers: dict[int, pa.Table]) -> pa.Table:
        suffixes, found, first, place, strings = known(group, answers)
        masks, later = np.zeros(len(first), dtype=np.uint32), np.zeros(len(strings["one"]), dtype=np.uint8)
        if 2 in answers:
            rare = found["said"][first] & _COMMON == 0
            masks[rare] = grouped.from_parts(of_strings(answers[2], False), part_of(found, first[rare]), "u4")
            later = grouped.from_parts(of_strings(answers[2], True), string_part(strings), "u1")
        hit = (strings["id"] > strings["id"][strings["one"]][strings["place"]]) | (later[strings["place"]] > 0)
        np.bitwise_or.at(masks, strings["kind"][hit], np.uint32(1) << strings["before"][hit].astype(np.uint32))
        owners = group.ids[found["text"]]
        # Where the group itself has an earlier document with the same surroundings, all is found.
        mask = np.where(owners > owners[first][place], whole, masks[place]) if len(first) else np.zeros(0, np.uint32)
        rows: list[tuple] = []
        for k, (_, offsets, data) in enumerate(suffixes.slices):
            here = found["slice"] == k
            at, bits, low, high = found["at"][here], mask[here], found["low"][here], found["high"][here]
            starts = [
                at[((bits >> np.uint32(b)) & np.uint32(1)).astype(bool) & (low <= b) & (b <= high)] - b
                for b in range(reach + 1)
            ]
            gone = covered(len(data), np.unique(np.concatenate(starts)), length)
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                own = gone[a:b]
                kept = data[a:b][~own].tobytes()
                spans = int(np.count_nonzero(own[1:] & ~own[:-1])) + int(b > a and own[0])
                rows.append((b - a, int(own.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 if with_text else 4]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        columns = [pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))]
        out = pa.table(columns, names=names).take(pa.array(group.text_of_row))
        return out.add_column(0, "doc_id", group.table["doc_id"])

    one = grouped.as_round(grouped.ask(texts, send_anchors, reply_repeated), 1)
    two = grouped.as_round(grouped.ask(texts, send_contexts, reply_matches, one), 2)
    return grouped.with_answers(texts, one.unionAll(two), remove, schema)
