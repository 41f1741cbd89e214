"""Nearest neighbours by a block matrix join (operator 7).

A tile is one block of queries against one block of candidates: the product of their int8 codes gives every distance up
to a known quantisation error, and only pairs whose lower bound does not exceed the ``k``-th smallest upper bound of their
query, nor the ``k``-th distance found so far, are recomputed in double precision. Each task merges its tiles to one heap of
at most ``k`` neighbours a query; the tasks' heaps are merged by rank. The result is exact.

Candidates are read where they lie and never moved. Queries go to the tasks in groups of bounded size, one pass over the
candidates for each group.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.jobs import written

CANDIDATE_BLOCK, QUERY_BLOCK = 4096, 512
#: Bytes of query vectors that one pass over the candidates sends to every task.
SENT_BYTES = 1 << 24
#: Part of a tile's largest component below which its distances are not told apart by bounds.
TINY = 1e-150


def usable(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, embedding as doubles) of the vectors that take part: not null, finite, not zero."""
    e = F.col(embedding).cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    nonzero = F.exists(e, lambda x: x != 0)
    return df.select(F.col(vec_id).cast("long").alias("vec_id"), e.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & e.isNotNull() & F.coalesce(finite & nonzero, F.lit(False))
    )


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale of each vector, and the length of what the codes leave out; components are 1 at most."""
    scale = np.abs(x).max(1) / 127
    scale[scale < np.finfo(float).tiny] = 1.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    return codes, scale, np.sqrt(((x - codes * scale[:, None]) ** 2).sum(1))


def distances(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances, term by term in double precision, so that every engine gets the same last digit; where squares
    leave the range of doubles, terms are scaled by a power of two first."""
    with np.errstate(over="ignore", under="ignore"):
        total = np.zeros(len(vectors))
        for d in range(len(query)):
            total += (query[d] - vectors[:, d]) ** 2
        out = np.sqrt(total)
        for i in np.flatnonzero((total < 1e-280) | ~np.isfinite(total)):
            difference, halved = query - vectors[i], 0
            if not np.isfinite(difference).all():
                difference, halved = query / 2 - vectors[i] / 2, 1
            most = np.abs(difference).max()
            if most:
                power = int(np.frexp(most)[1])
                out[i] = np.ldexp(np.sqrt((np.ldexp(difference, -power) ** 2).sum()), power + halved)
    return out


def tile(queries: np.ndarray, vectors: np.ndarray, others: np.ndarray, k: int, reach: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, candidates, distances) of all candidates that may be among a query's ``k`` nearest. ``others`` says which
    candidates a query has at all; ``reach`` is the largest distance that still matters to it."""
    power = int(np.frexp(max(np.abs(queries).max(), np.abs(vectors).max()))[1])
    qc, qs, qe = quantised(np.ldexp(queries, -power))
    cc, cs, ce = quantised(np.ldexp(vectors, -power))
    # products of int8 codes are whole numbers that these floats hold exactly
    kind = np.float32 if queries.shape[1] * 127 * 127 < 1 << 24 else np.float64
    dots = (qc.astype(kind) @ cc.astype(kind).T).astype(np.float64)
    qn, cn = (qc.astype(np.float64) ** 2).sum(1) * qs**2, (cc.astype(np.float64) ** 2).sum(1) * cs**2
    near = np.sqrt(np.maximum(qn[:, None] + cn[None] - 2 * dots * qs[:, None] * cs[None], 0))
    error = (qe[:, None] + ce[None]) * (1 + 1e-9) + 1e-7 * np.sqrt(np.maximum(qn[:, None], cn[None])) + TINY
    upper = np.where(others, near + error, np.inf)
    bound = np.partition(upper, k - 1, axis=1)[:, k - 1] if upper.shape[1] > k else np.full(len(queries), np.inf)
    with np.errstate(over="ignore", under="ignore"):
        bound = np.minimum(bound, np.ldexp(reach, -power) * (1 + 1e-9) + TINY)
    left = others & (near - error <= bound[:, None])
    for i in np.flatnonzero(left.any(1)).tolist():
        at = np.flatnonzero(left[i])
        yield i, at, distances(queries[i], vectors[at])


@dataclass
class Asked:
    """Queries of one length, and the heaps of their neighbours so far."""

    ids: np.ndarray
    keys: np.ndarray
    vectors: np.ndarray
    heaps: list[list[tuple[float, int]]] = field(default_factory=list)

    def meet(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        for a in range(0, len(self.ids), QUERY_BLOCK):
            part = slice(a, a + QUERY_BLOCK)
            reach = np.array([h[-1][0] if len(h) == k else np.inf for h in self.heaps[part]])
            others = self.ids[part][:, None] != ids[None]
            for i, at, found in tile(self.vectors[part], vectors, others, k, reach):
                self.heaps[a + i] = heapq.nsmallest(k, [*self.heaps[a + i], *zip(found.tolist(), ids[at].tolist(), strict=True)])


def by_length(rows: list) -> dict[int, Asked]:
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(len(r.embedding), []).append(r)
    return {n: Asked(np.array([r.vec_id for r in rs], np.int64), np.array([r.key for r in rs], np.int64), np.array([r.embedding for r in rs], np.float64)) for n, rs in out.items()}


def heaps(candidates: DataFrame, asked: dict[int, Asked], k: int) -> DataFrame:
    """(query_id, key, vec_id, score): of each task the k nearest of every query."""
    shared = candidates.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {n: Asked(q.ids, q.keys, q.vectors, [[] for _ in q.ids]) for n, q in shared.value.items()}
        held: dict[int, tuple[list, list]] = {}

        def meet(n):
            ids, rows = held.pop(n)
            own[n].meet(np.concatenate(ids), np.concatenate(rows), k)

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            lengths, values = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            for n in np.unique(lengths).tolist():
                if n not in own:
                    continue
                at = np.flatnonzero(lengths == n)
                rows = values[(ends[at] - n)[:, None] + np.arange(n)]
                for lo in range(0, len(at), CANDIDATE_BLOCK):
                    block = held.setdefault(n, ([], []))
                    block[0].append(ids[at[lo : lo + CANDIDATE_BLOCK]]), block[1].append(rows[lo : lo + CANDIDATE_BLOCK])
                    if sum(map(len, block[0])) >= CANDIDATE_BLOCK:
                        meet(n)
        for n in list(held):
            meet(n)
        for q in own.values():
            flat = [(i, key, v, d) for i, key, heap in zip(q.ids.tolist(), q.keys.tolist(), q.heaps, strict=True) for d, v in heap]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in flat], t) for i, t in enumerate(kinds)], ["query_id", "key", "vec_id", "score"])

    return candidates.mapInArrow(run, "query_id bigint, key bigint, vec_id bigint, score double")


def nearest(candidates: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", sent_bytes: int = SENT_BYTES) -> DataFrame:
    """The ``k`` nearest candidates of every query: query_id, rank (from 1), vec_id, score (Euclidean distance).

    A candidate with the query's own id is left out; fewer than k others give fewer rows; equal distances go by the
    smaller vec_id. Vectors that are null, zero or hold null or non-finite components take no part, nor do null ids;
    vectors of different length are not compared; a distance beyond the largest double is infinite. Repeated candidates count each. Equal rows of one query id are one
    query; different vectors of one id are queries of their own, each with ranks from 1.
    """
    wanted = usable(queries, vec_id, embedding).withColumn("key", F.xxhash64("embedding")).dropDuplicates(["vec_id", "key"])
    n, longest = wanted.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    groups = max(1, -(-n * longest * 8 // sent_bytes))
    others, found = usable(candidates, vec_id, embedding), None
    for g in range(groups):
        rows = wanted.filter(F.pmod(F.xxhash64("vec_id", "key"), F.lit(groups)) == g) if groups > 1 else wanted
        part = heaps(others, by_length(rows.collect()), k)
        part = written(part) if groups > 1 else part
        found = part if found is None else found.unionAll(part)
    order = Window.partitionBy("query_id", "key").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
