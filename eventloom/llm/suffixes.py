"""Repeated passages by sparse suffix arrays (operator 1).

A suffix is kept where a minimiser stands: of the ``key`` word runs in every window of ``least`` words the one with the
smallest hash. Two equal windows choose the same place, so a passage of ``least`` words that occurs twice has suffixes
of equal beginning in both places. Spark sorts all kept suffixes by range, by their leading ``key`` words (as one number)
and then by their surroundings; neighbours in that order are compared. Suffixes that begin alike extend the match to the
left and right in the same task: of the windows round them, one offset after the other, those equal to a neighbour's are
repeated, and overlapping ones join to spans of any length.

Whole surroundings that are equal (copies of documents, common passages within them) settle at once: all are repeated,
and only one of them is extended. A beginning that is shared by more suffixes than a task holds, and those that reach
over the end of a task's range, are extended by a count of their windows in Spark, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.arrays import U64, mix, range_hashes, slices, words
from eventloom.llm.jobs import written
from eventloom.llm.set_join import dealt, runs

#: Words of the shortest passage that counts.
LEAST_WORDS = 50
#: Suffixes of one beginning that a task compares by itself.
RUN_ROWS = 20_000


def anchors(hashes: np.ndarray, bounds: np.ndarray, least: int):
    """Kept suffixes of a slice: text, key, hash of the surroundings, first and last window start; and window hashes."""
    key = least // 2
    choice = least - key + 1
    n = len(hashes) - least + 1
    if n <= 0:
        return None
    at = np.arange(len(hashes) - key + 1)
    keys = range_hashes(hashes, at, at + key)
    place = np.lib.stride_tricks.sliding_window_view(mix(keys), choice)[:n].argmin(1) + np.arange(n)
    text = np.searchsorted(bounds, np.arange(n), "right") - 1
    whole = np.flatnonzero(np.arange(n) + least <= bounds[text + 1])
    if not len(whole):
        return None
    windows = range_hashes(hashes, whole, whole + least)
    new = np.append(True, (place[whole][1:] != place[whole][:-1]) | (text[whole][1:] != text[whole][:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(whole)) - 1
    around = range_hashes(hashes, whole[first], whole[last] + least) + (place[whole[first]] - whole[first]).astype(np.uint64) * U64(0x9E3779B97F4A7C15)
    return text[whole[first]], keys[place[whole[first]]], around, place[whole[first]], whole[first], whole[last], first, last, windows


def suffixes(docs: DataFrame, least: int) -> DataFrame:
    """(key, around, doc_id, first, last, back, windows): the kept suffixes, with their window starts and window hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for part in slices(batch.column(1)):
                found = words(part)
                kept = anchors(found.hashes, found.bounds, least)
                if kept is None:
                    continue
                text, key, around, place, start, end, a, b, windows = kept
                raw = windows.tobytes()
                own = [raw[i * 8 : (j + 1) * 8] for i, j in zip(a.tolist(), b.tolist(), strict=True)]
                zero = found.bounds[text]
                columns = [pa.array(key.view(np.int64)), pa.array(around.view(np.int64)), pa.array(ids[part.lo + text]), pa.array((start - zero).astype(np.int32)), pa.array((end - zero).astype(np.int32)), pa.array((place - start).astype(np.int32)), pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "around", "doc_id", "first", "last", "back", "windows"])

    return docs.mapInArrow(run, "key bigint, around bigint, doc_id bigint, first int, last int, back int, windows binary")


SPANS = ["window", "doc_id", "start", "end"]


def spans_batch(window: pa.Array, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([window, pa.array(doc, pa.int64()), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], SPANS)


def extended(rows: pa.RecordBatch, alike: np.ndarray, same: np.ndarray, leads: np.ndarray, whole: np.ndarray, least: int) -> Iterator[pa.RecordBatch]:
    """Spans of consecutive suffixes. ``alike``: has a neighbour of equal beginning; ``same``: one of equal surroundings;
    ``leads``: the first of its equals; ``whole``: all suffixes of its beginning are among these rows.

    Windows of suffixes that are not whole are left open, for Spark to count.
    """
    column = lambda name: rows.column(rows.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
    first, last, doc = column("first"), column("last"), column("doc_id")
    settled = np.flatnonzero(same)
    if len(settled):
        yield spans_batch(pa.nulls(len(settled), pa.int64()), doc[settled], first[settled], last[settled] + least)
    at = np.flatnonzero(alike & leads)
    if not len(at):
        return
    counts = (last - first + 1)[at]
    hashes = np.frombuffer(b"".join(rows.column(rows.schema.get_field_index("windows")).take(pa.array(at)).to_pylist()), np.uint64)
    owner = np.repeat(at, counts)
    step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    offset = column("back")[owner] - step
    window = mix(hashes + mix(column("key").view(np.uint64)[owner] + offset.astype(np.uint64)))
    start = first[owner] + step
    inside = np.flatnonzero(whole[owner])
    if len(inside):
        _, which, n = np.unique(window[inside], return_inverse=True, return_counts=True)
        again = inside[n[which] > 1]
        if len(again):
            # consecutive windows of one suffix are one span
            new = np.append(True, (owner[again][1:] != owner[again][:-1]) | (start[again][1:] != start[again][:-1] + 1))
            a, b = again[new], again[np.append(np.flatnonzero(new)[1:], len(again)) - 1]
            yield spans_batch(pa.nulls(len(a), pa.int64()), doc[owner[a]], start[a], start[b] + least)
    left = np.flatnonzero(~whole[owner])
    if len(left):
        yield spans_batch(pa.array(window[left].view(np.int64)), doc[owner[left]], start[left], start[left] + least)


def compared(sorted_suffixes: DataFrame, least: int, run_rows: int = RUN_ROWS) -> DataFrame:
    """(window, doc_id, start, end): spans that neighbours settle (window null), and single windows that are still open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before, border, hot = None, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            key, around = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            border = key[0] if border is None else border
            cut = int(np.searchsorted(key, key[-1]))
            if cut == 0 and batch.num_rows > run_rows:
                hot, cut = key[0], batch.num_rows - 1
            held = batch.slice(cut)
            if cut:
                yield from extended(batch.slice(0, cut), *flags(key, around, cut, before), (key[:cut] != border) & (key[:cut] != hot) if hot is not None else key[:cut] != border, least)
                before = key[cut - 1], around[cut - 1]
        if held is not None:
            # the last beginning may go on in the next range, as the first one may have begun in the one before
            key, around = (held.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            alike, same, leads = flags(np.append(key, key[-1]), np.append(around, ~around[-1]), len(key), before)
            yield from extended(held, alike, same, leads, np.zeros(len(key), bool), least)

    return sorted_suffixes.mapInArrow(run, "window bigint, doc_id bigint, start int, end int")


def flags(key: np.ndarray, around: np.ndarray, n: int, before) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """alike, same and leads (see ``extended``) of the first ``n`` rows, of which the next row and the one before are known;
    what stands before a range isn't, and may be alike."""
    equal = key[1:] == key[:-1]
    twin = equal & (around[1:] == around[:-1])
    equal_before = before is None or before[0] == key[0]
    twin_before = before is not None and before == (key[0], around[0])
    after = lambda x: np.append(x, False)[:n]
    previous = lambda first, x: np.append(first, x)[:n]
    return after(equal) | previous(equal_before, equal), after(twin) | previous(twin_before, twin), ~previous(twin_before, twin)


def merged(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of each document joined: doc_id, n_spans, n_words, spans."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words_, found = [], [], []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(f) for f in found], pa.int64()), pa.array(words_, pa.int64()), pa.array(found, kind)], ["doc_id", "n_spans", "n_words", "spans"])

        for table in runs(batches, 1, 1 << 30):
            start, end = table.column("start").to_numpy(), table.column("end").to_numpy()
            reach = np.maximum.accumulate(end)
            new = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
            a, b = start[new], reach[np.append(new[1:], len(start)) - 1]
            ids.append(table.column("doc_id")[0].as_py()), words_.append(int((b - a).sum()))
            found.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
            if len(ids) == 1000:
                yield flush()
                ids, words_, found = [], [], []
        if ids:
            yield flush()

    ordered = spans.repartition("doc_id").sortWithinPartitions("doc_id", "start").select("doc_id", "start", "end")
    return ordered.mapInArrow(run, "doc_id bigint, n_spans bigint, n_words bigint, spans array<struct<start:int,end:int>>")


def repeated_passages(docs: DataFrame, least: int = LEAST_WORDS, run_rows: int = RUN_ROWS) -> DataFrame:
    """Passages of at least ``least`` words that occur again, in another document or the same: doc_id, n_spans, n_words,
    spans (word numbers from 0, ends exclusive).

    A word belongs to a span exactly if some run of ``least`` consecutive words that holds it occurs at least twice in
    the corpus (overlapping occurrences count). Words are runs without white space (space, 0x09 to 0x0D), A-Z as a-z.
    Documents without such a passage, null and empty texts have no row. Rows with a null doc_id take no part; rows of
    one doc_id count as occurrences each, and their spans go together. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    ordered = dealt(suffixes(docs, least), ["key", "around"], ["doc_id", "first"])
    found = written(compared(ordered, least, run_rows))
    windows = found.filter(F.col("window").isNotNull())
    often = windows.groupBy("window").agg(F.count("*").alias("n")).filter(F.col("n") >= 2).select("window")
    again = windows.join(often, "window", "left_semi")
    return merged(found.filter(F.col("window").isNull()).select("doc_id", "start", "end").unionAll(again.select("doc_id", "start", "end")))
