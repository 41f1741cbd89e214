"""Benchmark decontamination by SimHash of item-sized windows (operator 3).

A window is as many words as a benchmark item has. Windows are fingerprinted by SimHash over their five-word shingles.
An index of ``BLOCKS`` blocks of bits returns every item of the window's length whose fingerprint lies within the radius:
two fingerprints that differ in RADIUS bits differ in BLOCK_RADIUS bits or fewer in one block at least, so the items of
near block values are all candidates there are; by chance one in seven items is, and whole fingerprints tell those that lie
within the radius. A block is looked up by each of the ``len(NEAR)`` values that lie near its own, or compared with the
values of the index where these are fewer. Candidates are verified by the exact weighted similarity of their shingles: the
sum of the smaller counts over the sum of the larger ones.

Only stretches of a text that can reach the similarity are fingerprinted: there, the share of shingles which occur in
any item at all is at least what the similarity asks for. Words are runs without white space, A-Z as a-z.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.arrays import shingle_hashes, slices, words

SHINGLE, SIMILARITY = 5, 0.8
#: Bits of a fingerprint, blocks of its index, and the bits by which one block of two near fingerprints may differ. At
#: similarity 0.8 fingerprints differ in 10 bits on average (deviation 3).
BITS, BLOCKS, BLOCK_RADIUS = 64, 4, 4
#: Bits by which fingerprints of similar windows may differ: with more, every block may differ in more than BLOCK_RADIUS.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Characters of benchmark text that one pass over the documents sends to its tasks; a larger benchmark takes several.
PASS_CHARS = 32_000_000

#: Pairs of window and block value, or of window and item, that are looked at at once.
PAIRS = 1 << 20

_shifts = np.arange(BITS, dtype=np.uint64)
_values = np.arange(1 << BITS // BLOCKS, dtype=np.uint16)
#: What a block is changed by to get the block values near it.
NEAR = _values[np.bitwise_count(_values) <= BLOCK_RADIUS]


def blocks(prints: np.ndarray) -> np.ndarray:
    """The blocks of each fingerprint, as 16-bit numbers."""
    return np.ascontiguousarray(prints).view(np.uint16).reshape(-1, BLOCKS)


def signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for every bit of every shingle's hash."""
    return ((shingles[:, None] >> _shifts & np.uint64(1)).astype(np.int8) * 2 - 1).astype(np.int8)


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64)[:, 0]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two lists of shingles; a shingle's weight is its count."""
    (ka, ca), (kb, cb) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    both = np.minimum(ca[ia], cb[ib]).sum()
    return float(both / (len(a) + len(b) - both)) if len(a) + len(b) else 0.0


@dataclass
class Benchmark:
    """Items with their shingles and the block index. Items of fewer words than a shingle are one shingle."""

    ids: list
    shingles: list[np.ndarray]
    lengths: np.ndarray  # words of each item
    threshold: float
    known: np.ndarray = field(init=False)  # sorted shingles of all items
    sizes: np.ndarray = field(init=False)  # distinct numbers of words of the items with full shingles
    prints: np.ndarray = field(init=False)
    index: dict = field(init=False)  # of each length and block: values, bounds of their items, items, place of every value
    short: dict = field(init=False)

    def __post_init__(self):
        full = self.lengths >= SHINGLE
        self.known = np.unique(np.concatenate([s for s, f in zip(self.shingles, full, strict=True) if f] or [np.zeros(0, np.uint64)]))
        self.table = np.zeros(1 << 16, bool)
        self.table[self.known >> np.uint64(48)] = True
        self.sizes = np.unique(self.lengths[full])
        self.prints = np.concatenate([fingerprints(signs(s).astype(np.int32).sum(0)[None]) for s in self.shingles] or [np.zeros(0, np.uint64)])
        self.index = {}
        for n in self.sizes.tolist():
            place = np.flatnonzero(full & (self.lengths == n))
            of = blocks(self.prints[place])
            for b in range(BLOCKS):
                order = np.argsort(of[:, b], kind="stable")
                values, first = np.unique(of[order, b], return_index=True)
                at = None
                if len(values) > len(NEAR):
                    at = np.full(len(_values), -1, np.int32)
                    at[values] = np.arange(len(values))
                self.index[n, b] = values, np.append(first, len(place)), place[order], at
        self.short = {}
        for i in np.flatnonzero(~full):
            self.short.setdefault(int(self.lengths[i]), {}).setdefault(int(self.shingles[i][0]), []).append(int(i))

    def hits(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles occur in any item."""
        found = self.table[shingles >> np.uint64(48)]
        at = np.flatnonzero(found)
        place = np.minimum(np.searchsorted(self.known, shingles[at]), max(len(self.known) - 1, 0))
        found[at] = self.known[place] == shingles[at] if len(self.known) else False
        return found

    def near_values(self, blocks_: np.ndarray, n: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, place of a value in the index) of block values that lie near: by look-up or, of few values, by comparison."""
        values, _, _, at = self.index[n, b]
        if at is None:
            return np.nonzero(np.bitwise_count(blocks_[:, None] ^ values[None]) <= BLOCK_RADIUS)
        found = at[blocks_[:, None] ^ NEAR[None]]
        w, v = np.nonzero(found >= 0)
        return w, found[w, v]

    def near(self, prints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of ``n`` words each that lie near in some block; in several blocks, several times."""
        windows, found, of = [], [], blocks(prints)
        for b in range(BLOCKS):
            _, bounds, items, _ = self.index[n, b]
            w, v = self.near_values(of[:, b], n, b)
            counts = bounds[v + 1] - bounds[v]
            inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            windows.append(np.repeat(w, counts)), found.append(items[np.repeat(bounds[v], counts) + inside])
        return np.concatenate(windows), np.concatenate(found)

    def candidates(self, prints: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of the same number of words whose fingerprints differ in RADIUS bits at most, every pair once."""
        pairs = [np.zeros(0, np.int64)]
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            values, _, items, _ = self.index[n, 0]
            step = max(1, PAIRS // max(min(len(values), len(NEAR)), len(items)))
            for some in (at[k : k + step] for k in range(0, len(at), step)):
                w, i = self.near(prints[some], n)
                close = np.flatnonzero(np.bitwise_count(prints[some[w]] ^ self.prints[i]) <= RADIUS)
                pairs.append(some[w[close]] * len(self.ids) + i[close])
        pairs = np.unique(np.concatenate(pairs))
        return pairs // max(len(self.ids), 1), pairs % max(len(self.ids), 1)


def read_items(rows: list[tuple], threshold: float) -> Benchmark:
    texts = pa.array([t for _, t in rows], pa.large_string())
    ids, shingles, lengths = [], [], []
    for part in slices(texts):
        found = words(part)
        for i in range(len(part)):
            h = found.hashes[found.bounds[i] : found.bounds[i + 1]]
            if len(h):
                ids.append(rows[part.lo + i][0]), lengths.append(len(h))
                shingles.append(shingle_hashes(h, min(SHINGLE, len(h))))
    return Benchmark(ids, shingles, np.array(lengths, np.int64), threshold)


def matches(bench: Benchmark, part) -> list[tuple[int, int, float, int]]:
    """(text, item, similarity, first word) of the best window of every text and item at or above the threshold."""
    found = words(part)
    best: dict[tuple[int, int], tuple[float, int]] = {}

    def keep(text, item, value, start):
        old = best.get((text, item))
        if old is None or (value, -start) > (old[0], -old[1]):
            best[text, item] = value, start

    if len(bench.sizes):
        shingles = shingle_hashes(found.hashes, SHINGLE)
        hit = bench.hits(shingles)
        sums = np.append(0, np.cumsum(hit))
        least = 2 * bench.threshold / (1 + bench.threshold)  # share of common shingles, of two lists of one length
        smallest = int(bench.sizes[0])
        texts, starts, lengths = [], [], []
        for i in range(len(part)):
            a, b = int(found.bounds[i]), int(found.bounds[i + 1])
            if b - a < SHINGLE or sums[b - SHINGLE + 1] - sums[a] < least * (min(smallest, b - a) - SHINGLE + 1) - 1e-9:
                continue
            for n in bench.sizes.tolist():
                size = min(n, b - a) - SHINGLE + 1
                s = sums[a : b - SHINGLE + 2]
                # a text shorter than the item is one window; its similarity cannot exceed size / items' shingles
                good = np.flatnonzero(s[size:] - s[:-size] >= least * (n - SHINGLE + 1) - (1e-9 if b - a >= n else (n - SHINGLE + 1 - size)))
                if len(good):
                    texts.append(np.full(len(good), i)), starts.append(good + a), lengths.append(np.full(len(good), n))
        if texts:
            texts, starts, lengths = np.concatenate(texts), np.concatenate(starts), np.concatenate(lengths)
            for at in range(0, len(texts), 4096):
                t, s, n = texts[at : at + 4096], starts[at : at + 4096], lengths[at : at + 4096]
                ends = np.minimum(s + n, found.bounds[t + 1]) - SHINGLE + 1
                inside = np.zeros(len(shingles) + 1, np.int32)
                np.add.at(inside, s, 1), np.add.at(inside, ends, -1)
                covered = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
                bit_sums = np.vstack([np.zeros((1, BITS), np.int32), np.cumsum(signs(shingles[covered]), 0, dtype=np.int32)])
                first = np.searchsorted(covered, s)
                prints = fingerprints(bit_sums[first + (ends - s)] - bit_sums[first])
                for w, item in zip(*(x.tolist() for x in bench.candidates(prints, n)), strict=True):
                    value = similarity(shingles[s[w] : ends[w]], bench.shingles[item])
                    if value >= bench.threshold:
                        keep(int(t[w]), item, value, int(s[w] - found.bounds[t[w]]))
    for n, index in bench.short.items():
        # an item of few words has one shingle: only the same words are similar
        h = shingle_hashes(found.hashes, n)
        owner = np.searchsorted(found.bounds, np.arange(len(h)), "right") - 1
        whole = found.bounds[owner + 1] - np.arange(len(h)) >= n
        for at in np.flatnonzero(whole & np.isin(h, np.array(list(index), np.uint64))):
            for item in index[int(h[at])]:
                keep(int(owner[at]), item, 1.0, int(at - found.bounds[owner[at]]))
    return [(text, item, value, start) for (text, item), (value, start) in sorted(best.items())]


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, pass_chars: int = PASS_CHARS) -> DataFrame:
    """Benchmark items that a document contains: doc_id, item_id, similarity, first_word, n_words.

    One row for each document and item of which some window of the item's number of words (the whole text, if it is
    shorter) has at least ``threshold`` weighted similarity; the best window, the first of equals. Null and empty texts
    and items match nothing; a null doc_id or item_id is returned as null; repeated rows match each.
    """
    items = keyed(benchmark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for bench in passes(items, threshold, pass_chars):
        found = source.mapInArrow(finder(docs.sparkSession.sparkContext.broadcast(bench)), "doc_id bigint, key bigint, similarity double, first_word int, n_words int")
        out = found if out is None else out.unionAll(found)
    return out.join(items.select("key", "item_id"), "key").select("doc_id", "item_id", "similarity", "first_word", "n_words")


def keyed(benchmark: DataFrame) -> DataFrame:
    """(key, item_id, text) of items with a text; equal texts have one key."""
    return benchmark.filter(F.length("text") > 0).select(F.xxhash64("text").alias("key"), "item_id", "text")


def passes(items: DataFrame, threshold: float, pass_chars: int) -> Iterator[Benchmark]:
    """The benchmark's different texts in parts of about ``pass_chars`` characters, by their keys."""
    texts = items.select("key", "text").distinct()
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // pass_chars))
    for p in range(n):
        rows = texts.filter(F.pmod("key", F.lit(n)) == p) if n > 1 else texts
        yield read_items([tuple(r) for r in rows.collect()], threshold)


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, pass_chars: int = PASS_CHARS) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, with all their columns; null and empty texts stay."""
    at = docs.columns.index("text")
    for bench in passes(keyed(benchmark), threshold, pass_chars):
        docs = docs.mapInArrow(cleaner(docs.sparkSession.sparkContext.broadcast(bench), at), docs.schema)
    return docs


def cleaner(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for part in slices(batch.column(at)):
                keep[[part.lo + f[0] for f in matches(shared.value, part)]] = False
            yield batch.filter(pa.array(keep))

    return run


def finder(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = shared.value
        for batch in batches:
            for part in slices(batch.column(1)):
                found = matches(bench, part)
                if found:
                    doc_ids = batch.column(0).take(pa.array([part.lo + f[0] for f in found]))
                    columns = [doc_ids, pa.array([bench.ids[f[1]] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.int32()), pa.array([int(bench.lengths[f[1]]) for f in found], pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "similarity", "first_word", "n_words"])

    return run
