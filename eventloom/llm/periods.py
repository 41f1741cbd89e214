"""Periodic runs of words (operator 13): stretches that repeat with a period, and texts without the repeats.

A suffix automaton is built over the words; its suffix links form a tree. Words are then taken one by one: the path from
the state of the prefix so far to the root is accessed as in a link-cut tree, where every preferred path carries the last
end of its states. The segments that the access meets give (earlier end, common length): if the distance of the ends is
within the length, the words between repeat, and the square is extended to its run.

The automaton sees only stretches that can hold a run. A run of period q repeats every group of words at most q back, at
all its places after the first period; stretches of enough such places, for each power of two, are found over whole
texts with numpy, and none that holds a run is left out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.jobs import pieces

#: A run has at least so many words, and so many times its period.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: Words of a group, for periods above SHORT; shorter periods are looked for by single words.
GROUP, SHORT = 4, 4
FAR = np.int64(1) << 40
EMPTY = hashlib.sha256(b"").hexdigest()

Reorder = Callable[[int | None, int], np.ndarray | None]


def suffix_tree(word: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links, longest lengths of the automaton's states, and the state of each prefix. State 1 is the start."""
    link, length, following = [0, 0], [0, 0], [{}, {}]
    last, prefix = 1, []
    for c in word:
        now = len(link)
        link.append(1), length.append(length[last] + 1), following.append({})
        p = last
        while p and c not in following[p]:
            following[p][c] = now
            p = link[p]
        if p:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                copy = len(link)
                link.append(link[q]), length.append(length[p] + 1), following.append(following[q].copy())
                link[q] = link[now] = copy
                while p and following[p].get(c) == q:
                    following[p][c] = copy
                    p = link[p]
        last = now
        prefix.append(now)
    return link, length, prefix


class Paths:
    """The suffix link tree under accesses: preferred paths in splay trees, each with the last end of its states."""

    def __init__(self, link: list[int]):
        self.up = list(link)  # parent in the splay tree; of a tree's root, the state above the path
        self.above = [0] * len(link)  # child with the shorter states of the path
        self.below = [0] * len(link)  # child with the longer ones
        self.end = [0] * len(link)  # at the root of a splay tree: last end of the path's states, 0 for none

    def splay(self, x: int) -> None:
        up, above, below = self.up, self.above, self.below

        def rotate() -> None:
            p = up[x]
            g = up[p]
            if above[g] == p:
                above[g] = x
            elif below[g] == p:
                below[g] = x
            else:  # p was the root: its end moves on
                self.end[x] = self.end[p]
            if above[p] == x:
                child = above[p] = below[x]
                below[x] = p
            else:
                child = below[p] = above[x]
                above[x] = p
            if child:
                up[child] = p
            up[p], up[x] = x, g

        while True:
            p = up[x]
            if not p or (above[p] != x and below[p] != x):
                return
            g = up[p]
            if g and (above[g] == p or below[g] == p) and (above[g] == p) == (above[p] == x):
                x, inner = p, x
                rotate()
                x = inner
            elif g and (above[g] == p or below[g] == p):
                rotate()
            rotate()

    def access(self, state: int, end: int) -> list[tuple[int, int]]:
        """(earlier end, longest state) of the segments on the path from a state to the root, which now all end at ``end``."""
        up, below, ends = self.up, self.below, self.end
        met, x, deeper = [], state, 0
        while x:
            self.splay(x)
            if ends[x]:
                met.append((ends[x], x))
            cut = below[x]
            if cut:
                ends[cut] = ends[x]
            below[x] = deeper
            deeper, x = x, up[x]
        ends[deeper] = end
        return met


def stretch_runs(word: list[int]) -> Iterator[tuple[int, int, int]]:
    """(start, length, smallest period) of stretches of at least LEAST_TIMES periods that don't go on to the right."""
    link, length, prefix = suffix_tree(word)
    paths, n, more = Paths(link), len(word), LEAST_TIMES - 1
    for i, state in enumerate(prefix, 1):
        for end, x in paths.access(state, i):
            period = i - end
            # the words up to i and those up to the earlier end have length[x] words in common: beyond one period, a square
            if length[x] >= more * period and (i == n or word[i] != word[end]):
                yield i - length[x] - period, length[x] + period, period


def gaps(keys: np.ndarray) -> np.ndarray:
    """Distance of each place to the last one before it with the same key; FAR if there is none."""
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    out = np.full(len(keys), FAR)
    out[order[same + 1]] = order[same + 1] - order[same]
    return out


def stretches(ids: np.ndarray, text_of: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint stretches within texts that hold every run. ``text_of`` is each word's text, ``starts`` the first word of each."""
    n = len(ids)
    if n < LEAST_WORDS:
        return []
    near = gaps(text_of * (int(ids.max()) + 1) + ids)
    groups, found = None, []
    ends = np.append(starts[1:], n)
    longest = int((ends - starts).max())
    size = 1  # periods above size / 2 and up to size
    while size // 2 * LEAST_TIMES < longest:
        shortest = size // 2 + 1
        if size <= SHORT:
            gap, width = near, 1
        else:
            if groups is None:
                key = text_of.astype(np.uint64)
                for k in range(GROUP):
                    key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
                    key[: n - k] += ids[k:].astype(np.uint64) + np.uint64(1)
                groups = gaps(key)
            gap, width = groups, GROUP
        need = max(LEAST_WORDS, LEAST_TIMES * shortest) - shortest - width + 1
        good = np.concatenate([[False], gap <= size, [False]])
        edges = np.flatnonzero(good[1:] != good[:-1])
        first, last = edges[::2], edges[1::2]
        long = last - first >= need
        for a, b in zip(first[long].tolist(), last[long].tolist(), strict=True):
            text = text_of[a]
            found.append((max(int(starts[text]), a - size), min(int(ends[text]), b + width - 1)))
        size *= 2
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1] and text_of[a] == text_of[out[-1][0]]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def extended(ids: np.ndarray, start: int, length: int, period: int) -> tuple[int, int, int]:
    """A stretch with a period as long as neighbouring words keep it."""
    end = start + length
    while start and ids[start - 1] == ids[start - 1 + period]:
        start -= 1
    while end < len(ids) and ids[end] == ids[end - period]:
        end += 1
    return start, end - start, period


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """For each text, given as word numbers, its runs (start, length, period) by start, then period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    out: list[set[tuple[int, int, int]]] = [set() for _ in texts]
    filled = np.flatnonzero(lengths)
    if len(filled):
        ids = np.concatenate(texts)
        text_of = np.repeat(np.arange(len(filled)), lengths[filled])
        for a, b in stretches(ids, text_of, starts[filled]):
            text = int(filled[text_of[a]])
            base = a - int(starts[text])
            for start, length, period in stretch_runs(ids[a:b].tolist()):
                run = extended(texts[text], base + start, length, period)
                if run[1] >= max(LEAST_WORDS, LEAST_TIMES * period):
                    out[text].add(run)
    return [sorted(found, key=lambda r: (r[0], r[2])) for found in out]


def numbered(words: list[bytes], numbers: dict[bytes, int]) -> np.ndarray:
    """Words as numbers; equal words have equal ones."""
    for w in dict.fromkeys(words):
        if w not in numbers:
            numbers[w] = len(numbers)
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The order in which a fixed tenth of the documents, by id, are read: from some word on, a stretch of words again and
    again. None for all others, for documents without an id and for those without words."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at >= a, a + (at - a) % p, at)


def periodic_runs(docs: DataFrame, reorder: Reorder | None = None, keep_runs: bool = False) -> DataFrame:
    """Runs of each document's words (``[^\\x20\\x09-\\x0D]+``, compared byte by byte), and its text without the repeats.

    A run is a stretch of words with smallest period q and at least max(6, 4 * q) words that no neighbouring word extends.
    Returns doc_id, n_runs; start, length, period, exponent_milli of the run with the greatest length / period (ties: the
    smallest start, then period; null without a run); runs_sha256 of all runs as lines ``start,length,period``;
    collapsed_sha256 of the words outside of all repeats joined by a space, where a run's first q words are no repeat;
    n_words, n_kept; and, with ``keep_runs``, the runs and the collapsed text. ``reorder`` gives, for (doc_id, number of
    words), the order in which words are read (None: as they stand). A null text has no words; rows with a null or a
    repeated doc_id are looked at each; other columns are ignored.
    """
    schema = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string, n_words bigint, n_kept bigint"
    if keep_runs:
        schema += ", runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    names = [part.strip().split(" ")[0] for part in schema.split(", runs ")[0].split(",")] + ["runs", "collapsed"] * keep_runs
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.int64()] * 2 + [run_type, pa.string()] * keep_runs

    def described(doc_id: int | None, words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
        kept = words
        if runs:
            keep = np.ones(len(words), bool)
            for start, length, period in runs:
                keep[start + period : start + length] = False
            kept = list(compress(words, keep.tolist()))
            best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
            shown = (*best, 1000 * best[1] // best[2])
            of_runs = hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        else:
            shown, of_runs = (None,) * 4, EMPTY
        collapsed = b" ".join(kept)
        row = doc_id, len(runs), *shown, of_runs, hashlib.sha256(collapsed).hexdigest(), len(words), len(kept)
        return (*row, [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], collapsed.decode()) if keep_runs else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                ids, texts, numbers = part.column(0).to_pylist(), [], {}
                words = [(t or "").encode().split() for t in part.column(1).to_pylist()]  # splits at those six bytes
                for i, doc_id in enumerate(ids):
                    order = reorder(doc_id, len(words[i])) if reorder else None
                    if order is not None:
                        words[i] = [words[i][k] for k in order.tolist()]
                    texts.append(numbered(words[i], numbers))
                rows = [described(*row) for row in zip(ids, words, runs_of(texts), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
