"""Exact n-gram Jaccard join and its connected components, by set relation skipping (operator 2).

Sets of word shingles are joined over inverted lists of their prefixes. Work is skipped on two levels:

* index level: lists are read in blocks by position. Two sets whose first common shingle stands at positions i and j
  differ in i + j shingles at least, so blocks whose positions add up to more than the threshold lets differ are
  skipped; so are sets of too different size, and pairs whose parity bitmaps differ in more bits than that.
* answer level: identical sets have one answer. A set that is known to be similar to another takes over that one's
  component, and what is known of their distances to a common set (Jaccard distance is a metric) settles most of the
  other comparisons. Only pairs between different components are ever compared.

The steps: one set stands for all identical ones; the first blocks of the lists, where highly similar sets meet almost
always, give rough groups; within a group exact similarities link sets, and each linked set takes over the answer of the
one it links to; then all blocks of all lists are read for pairs between different components, which makes the result
whole whatever the first blocks missed. Frequent shingles come last in the order of all sets, so their lists stay short.
All groups are cut to bounded chunks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.arrays import U64, mix, shingle_hashes, slices, text_shingles, words
from eventloom.llm.components import components
from eventloom.llm.jobs import pieces, written

#: A shingle that is among the first HEAD of so many sets is frequent; so many of them are sent to every task.
HEAD, FREQUENT, MAX_FREQUENT = 8, 6, 200_000
#: Bits of a set's parity bitmap: small sets, and sets from LARGE shingles on.
SMALL_BITS, LARGE_BITS, LARGE = 1024, 8192, 2048
#: Positions of a list's first block, read before all others.
FIRST = 3
CHUNK, LIST_CHUNK = 384, 1024
#: Rows after it that a row of a list is compared to, before the lists proper are read.
REACH = 8
#: Bits of the filter that tells which documents' sets are wanted: so many for each id, within these bounds.
ID_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 28


@dataclass(frozen=True)
class Rule:
    """Sets of ``k``-word shingles link when den * common >= num * union."""

    k: int = 5
    num: int = 80
    den: int = 100

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def links(self, common, a, b):
        return self.den * common >= self.num * (a + b - common)

    def difference(self, a, b):
        """Shingles at most that are in one of two linked sets only."""
        least = -(-self.num * (a + b) // (self.num + self.den))
        return a + b - 2 * least

    def most_difference(self, a, b):
        """``difference`` at most of sets of no more than ``a`` and ``b`` shingles: that itself may fall as sizes grow."""
        return (self.den - self.num) * (a + b) // (self.num + self.den)

    @property
    def distance(self) -> float:
        return 1 - self.num / self.den


def doc_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of every text."""
    for part in slices(column):
        found = words(part)
        shingles = shingle_hashes(found.hashes, k)
        for i in range(len(part)):
            yield np.unique(text_shingles(found, shingles, i, k))


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity bitmap: every shingle flips one bit, so two bitmaps differ in no more bits than their sets in shingles.

    The large one folds to the small one, as bit positions agree modulo SMALL_BITS.
    """
    bits = SMALL_BITS if len(tokens) < LARGE else LARGE_BITS
    counts = np.bincount((tokens >> U64(20)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def bitmaps(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Small bitmaps of all sets, large ones of those that have one, and which these are."""
    large = np.array([len(r) * 8 == LARGE_BITS for r in raw])
    small = np.zeros((len(raw), SMALL_BITS // 64), np.uint64)
    wide = None
    if large.any():
        wide = np.zeros((len(raw), LARGE_BITS // 64), np.uint64)
        wide[large] = np.frombuffer(b"".join(r for r, w in zip(raw, large, strict=True) if w), np.uint64).reshape(-1, LARGE_BITS // 64)
        small[large] = np.bitwise_xor.reduce(wide[large].reshape(large.sum(), -1, SMALL_BITS // 64), axis=1)
    if not large.all():
        small[~large] = np.frombuffer(b"".join(r for r, w in zip(raw, large, strict=True) if not w), np.uint64).reshape(-1, SMALL_BITS // 64)
    return small, wide, large


def describe(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, n, s1, s2, head, bits): size, content hash, first shingles and bitmap of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(pieces, batches)):
            n, s1, s2, head, bits = [], [], [], [], []
            for tokens in doc_sets(batch.column(1), rule.k):
                n.append(len(tokens))
                s1.append(int(mix(tokens).sum().view(np.int64)) if len(tokens) else 0)
                s2.append(int(mix(tokens ^ U64(0xA0761D6478BD642F)).sum().view(np.int64)) if len(tokens) else 0)
                head.append(tokens[:HEAD].view(np.int64).tolist())
                bits.append(bitmap(tokens))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(head, pa.list_(pa.int64())), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "s1", "s2", "head", "bits"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, s1 bigint, s2 bigint, head array<bigint>, bits binary")


def prefixes(docs: DataFrame, rule: Rule, frequent: np.ndarray) -> DataFrame:
    """(token, n, doc_id, pos, often): the prefix of every set in the order rare shingles, then frequent ones (``often``),
    each by hash."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = shared.value
        for batch in itertools.chain.from_iterable(map(pieces, batches)):
            ids, tokens, often, lengths, sizes = batch.column(0).to_numpy(zero_copy_only=False), [], [], [], []
            for found in doc_sets(batch.column(1), rule.k):
                n, common = len(found), np.zeros(len(found), bool)
                if n and len(last):
                    at = np.minimum(np.searchsorted(last, found), len(last) - 1)
                    common = last[at] == found
                    if common.any():
                        found, common = np.concatenate([found[~common], found[common]]), np.sort(common)
                p = rule.prefix(n) if n else 0
                tokens.append(found[:p]), often.append(common[:p]), lengths.append(p), sizes.append(n)
            lengths = np.array(lengths)
            flat, often = np.concatenate(tokens).view(np.int64), np.concatenate(often)
            pos = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            for a in range(0, len(flat), 20_000):
                b = slice(a, a + 20_000)
                columns = [pa.array(flat[b]), pa.array(np.repeat(np.array(sizes, np.int32), lengths)[b]), pa.array(np.repeat(ids, lengths)[b]), pa.array(pos[b].astype(np.int32)), pa.array(often[b])]
                yield pa.RecordBatch.from_arrays(columns, ["token", "n", "doc_id", "pos", "often"])

    return docs.mapInArrow(run, "token bigint, n int, doc_id bigint, pos int, often boolean")


def runs(batches: Iterator[pa.RecordBatch], keys: int, limit: int) -> Iterator[pa.Table]:
    """Consecutive rows of equal first ``keys`` columns, cut after ``limit`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for c in range(keys):
            values = batch.column(c).to_numpy(zero_copy_only=False)
            change |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held and (a or any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in range(keys))):
                yield pa.Table.from_batches(held)
                held = []
            while a < b:
                room = limit - sum(h.num_rows for h in held)
                held.append(batch.slice(a, min(room, b - a)))
                a += min(room, b - a)
                if sum(h.num_rows for h in held) == limit:
                    yield pa.Table.from_batches(held)
                    held = []
    if held:
        yield pa.Table.from_batches(held)


def dealt(df: DataFrame, keys: list[str], ties: list[str]) -> DataFrame:
    """``df`` by range over keys and ties and sorted, so that frequent keys spread over tasks."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return df.repartitionByRange(n, *keys, *ties).sortWithinPartitions(*keys, *ties).select(*keys, *[c for c in df.columns if c not in keys])


def may_link(rule: Rule, sizes_a, small_a, wide_a, large_a, sizes_b, small_b, wide_b, large_b) -> np.ndarray:
    """Matrix of pairs whose sizes and bitmaps allow a link."""
    a, b = sizes_a[:, None], sizes_b[None]
    most = rule.difference(a, b)
    ok = (rule.den * np.minimum(a, b) >= rule.num * np.maximum(a, b))
    for i in np.flatnonzero(ok.any(1)):
        at = np.flatnonzero(ok[i])
        ok[i, at] = np.bitwise_count(small_a[i] ^ small_b[at]).sum(1) <= most[i, at]
        if large_a[i]:
            at = at[ok[i, at] & large_b[at]]
            if len(at):
                ok[i, at] = np.bitwise_count(wide_a[i] ^ wide_b[at]).sum(1) <= most[i, at]
    return ok


def rough_edges(reps: DataFrame, rule: Rule) -> DataFrame:
    """(u, v): sets that share a shingle of both their first FIRST positions and whose bitmaps allow a link; each is tied
    to one earlier set only."""
    keyed = reps.select(F.explode(F.slice("head", 1, FIRST)).alias("key"), "n", "doc_id", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run_ in runs(batches, 1, CHUNK):
            if run_.num_rows < 2:
                continue
            ids, sizes = run_.column("doc_id").to_numpy(), run_.column("n").to_numpy()
            views = bitmaps(run_.column("bits").to_pylist())
            small, wide, large = views
            u, v = [], []
            open_ = np.arange(len(ids))
            while len(open_) > 1:
                # breadth first: everything near the front joins it and is not looked at again
                front, open_ = [open_[0]], open_[1:]
                while front and len(open_):
                    x = front.pop()
                    pick = lambda s: (sizes[s], small[s], wide[s] if wide is not None else None, large[s])
                    near = may_link(rule, *pick(np.array([x])), *pick(open_))[0]
                    u += [int(ids[x])] * int(near.sum())
                    v += ids[open_[near]].tolist()
                    front += open_[near].tolist()
                    open_ = open_[~near]
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return dealt(keyed, ["key"], ["n", "doc_id"]).mapInArrow(run, "u bigint, v bigint")


def wanted_filter(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap, made by Spark, and its number of bits: bit h is set if an id hashes to h. It has ID_BITS for each id, and
    at most MOST_BITS."""
    bits = LEAST_BITS
    n = ids.count()
    while bits < min(n * ID_BITS, MOST_BITS):
        bits *= 2
    h = F.pmod(F.xxhash64("doc_id"), F.lit(bits)) + 1
    rows = ids.groupBy(F.bitmap_bucket_number(h).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(h)).alias("bits")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        out[(r.bucket - 1) * 4096 : r.bucket * 4096] = np.frombuffer(r.bits, np.uint8)
    return out, bits


def sets_of(docs: DataFrame, ids: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, tokens): the sets of at least the documents in ``ids``, from their whole texts.

    A filter leaves out most other documents before anything is moved; those it lets through are harmless, as callers join
    the result to ids. Beyond MOST_BITS / ID_BITS ids it saves less, up to nothing.
    """
    wanted_bits, bits = wanted_filter(ids)
    h = F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("h")
    shared = docs.sparkSession.sparkContext.broadcast(wanted_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            at = batch.column(2).to_numpy(zero_copy_only=False)
            rows = batch.filter(pa.array((wanted[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            for part in pieces(rows):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([t.tobytes() for t in doc_sets(part.column(1), rule.k)], pa.binary())], ["doc_id", "tokens"])

    return docs.select("doc_id", "text", h).mapInArrow(run, "doc_id bigint, tokens binary")


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Number of common members of two sorted arrays of distinct numbers."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


class Cluster:
    """A component in the making: its members, and the Jaccard distance of each to its first member where known."""

    def __init__(self, first: int):
        self.members, self.distance, self.gone = [first], [0.0], False


def link_sets(ids: list[int], labels: list[int], sets: list[np.ndarray], rule: Rule) -> list[tuple[int, int]]:
    """Links between sets of different labels that connect all that similarity connects; not every link, none too many.

    A set is compared to the first member of each component; its distance there and the metric's triangle rule out most
    members, and the first link found settles the whole component.
    """
    clusters: list[Cluster] = []
    by_label: dict[int, Cluster] = {}
    links = []

    def compare(x: int, y: int) -> tuple[bool, float]:
        n = common(sets[x], sets[y])
        a, b = len(sets[x]), len(sets[y])
        return rule.links(n, a, b), 1 - n / max(a + b - n, 1)

    def reaches(x: int, cluster: Cluster) -> tuple[int | None, float]:
        linked, d = compare(x, cluster.members[0])
        if linked:
            return cluster.members[0], d
        for y, known in zip(cluster.members[1:], cluster.distance[1:], strict=True):
            a, b = len(sets[x]), len(sets[y])
            if rule.den * min(a, b) < rule.num * max(a, b) or known == known and abs(d - known) > rule.distance + 1e-9:
                continue
            if compare(x, y)[0]:
                return y, d
        return None, d

    for x in sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i])):
        own, placed = by_label.get(labels[x]), False
        for cluster in list(clusters):
            if cluster is own or cluster.gone:
                continue
            y, d = reaches(x, cluster)
            if y is None:
                continue
            links.append((ids[x], ids[y]))
            if own is None:
                cluster.members.append(x), cluster.distance.append(d)
                own, placed = cluster, True
            else:
                small, big = sorted((own, cluster), key=lambda c: len(c.members))
                big.members += small.members
                big.distance += [float("nan")] * len(small.members)
                small.gone = True
                clusters.remove(small)
                for label, c in by_label.items():
                    if c is small:
                        by_label[label] = big
                own = big
            by_label[labels[x]] = own
        if own is None:
            own = Cluster(x)
            clusters.append(own)
            by_label[labels[x]] = own
        elif not placed:
            own.members.append(x), own.distance.append(float("nan"))
    return links


def exact_edges(grouped: DataFrame, rule: Rule, tie: str = "doc_id") -> DataFrame:
    """(u, v): labels that verified links connect, within chunks of rows (group, label, doc_id, tokens) of one group.

    A group is cut to chunks in the order of ``tie``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run_ in runs(batches, 1, CHUNK):
            if run_.num_rows < 2:
                continue
            ids, labels = run_.column("doc_id").to_pylist(), run_.column("label").to_pylist()
            of = dict(zip(ids, labels, strict=True))
            sets = [np.frombuffer(t, np.uint64) for t in run_.column("tokens").to_pylist()]
            links = {(of[a], of[b]) for a, b in link_sets(ids, labels, sets, rule)}
            links = sorted((a, b) for a, b in links if a != b)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["u", "v"])

    return dealt(grouped, ["group"], [tie]).mapInArrow(run, "u bigint, v bigint")


def relabelled(labels: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, label) with labels replaced by their components where ``found`` (id, component) has them."""
    return labels.join(found, labels["label"] == found["id"], "left").select("doc_id", F.coalesce("component", "label").alias("label"))


def partnered(lists: DataFrame, rule: Rule, labels: bool = False) -> DataFrame:
    """Rows of lists (token, n, doc_id, pos, often, with ``labels`` also label) that can have a partner in their list:
    another row whose size and position allow a link, and whose label is another one.

    Lists are sorted by size; each row is compared to the REACH rows after it, and rows of longer lists stay unseen. So do
    the rows that are marked ``often``, which are spread over the tasks by their documents.
    """
    columns = [*lists.columns]
    spread = lists.repartition("token", F.when(F.col("often"), F.xxhash64("doc_id"))).sortWithinPartitions("token", "n", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kept = None, np.zeros(0, bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            column = lambda c: batch.column(columns.index(c)).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            token, n, pos = column("token"), column("n").astype(np.int64), column("pos").astype(np.int64)
            keep = column("often").astype(bool)
            keep[: len(kept)] |= kept
            for d in range(1, REACH + 1):
                if d >= len(token):
                    break
                at = np.flatnonzero(token[d:] == token[:-d])
                if not len(at):
                    break
                a, b = n[at], n[at + d]
                fits = (rule.den * a >= rule.num * b) & (pos[at] + pos[at + d] <= rule.difference(a, b))
                if labels:
                    label = column("label")
                    fits &= label[at] != label[at + d]
                fits |= d == REACH
                keep[at[fits]] = True
                keep[at[fits] + d] = True
            cut = max(batch.num_rows - REACH, 0)
            held, kept = batch.slice(cut), keep[cut:]
            yield batch.slice(0, cut).filter(pa.array(keep[:cut]))
        if held is not None:
            yield held.filter(pa.array(kept))

    return spread.mapInArrow(run, lists.schema)


def list_pairs(lists: DataFrame, rule: Rule) -> DataFrame:
    """(u, v): pairs of one list and of different components that positions, sizes and bitmaps allow to link.

    ``lists`` has token, pos, doc_id, n, label, bits and rows, the length of the list if it may be a long one. A list
    longer than LIST_CHUNK is cut, and every two of its chunks meet in a task of their own.
    """
    parts = F.ceil(F.col("rows") / LIST_CHUNK).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")
    cut = lists.withColumn("parts", parts).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cut = cut.select("token", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "pos", "doc_id", "n", "label", "bits")
    cut = cut.repartition("token", "a", "b").sortWithinPartitions("token", "a", "b", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run_ in runs(batches, 3, 1 << 30):
            if run_.num_rows < 2:
                continue
            a, b = run_.column("a")[0].as_py(), run_.column("b")[0].as_py()
            own, pos, sizes, labels, ids = (run_.column(c).to_numpy().astype(np.int64) for c in ("own", "pos", "n", "label", "doc_id"))
            if (labels == labels[0]).all():
                continue
            small, wide, large = bitmaps(run_.column("bits").to_pylist())
            out = []
            step = 64
            starts = np.arange(0, len(ids), step)
            largest = np.maximum.reduceat(sizes, starts)
            for block, i in enumerate(starts.tolist()):
                # rows are in order of position: blocks that stand too far back in their sets can be left out, each by its
                # own sizes, as later ones may hold larger sets
                near = pos[i] + pos[starts[block:]] <= rule.most_difference(largest[block], largest[block:])
                for j in starts[block:][near].tolist():
                    s, t = slice(i, i + step), slice(j, j + step)
                    ok = labels[s][:, None] != labels[t][None]
                    ok &= pos[s][:, None] + pos[t][None] <= rule.difference(sizes[s][:, None], sizes[t][None])
                    if a != b:
                        ok &= own[s][:, None] != own[t][None]
                    if i == j:
                        ok &= np.triu(ok, 1)
                    if ok.any():
                        w = (wide[s], wide[t]) if wide is not None else (None, None)
                        ok &= may_link(rule, sizes[s], small[s], w[0], large[s], sizes[t], small[t], w[1], large[t])
                        x, y = np.nonzero(ok)
                        out += list(zip(ids[s][x].tolist(), ids[t][y].tolist(), strict=True))
            if out:
                out = sorted({(max(p), min(p)) for p in out})
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["u", "v"])

    return cut.mapInArrow(run, "u bigint, v bigint").distinct()


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (u, v, and what else they carry) whose sets link."""
    left = sets.select(F.col("doc_id").alias("u"), F.col("tokens").alias("tokens_u"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("tokens").alias("tokens_v"))
    both = pairs.join(left, "u").join(right, "v").select(*pairs.columns, "tokens_u", "tokens_v")
    n = len(pairs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(rule.links(common(a, b), len(a), len(b)))
            yield batch.select(list(range(n))).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, pairs.schema)


def sent_if_few(df: DataFrame, most: int = 500_000) -> DataFrame:
    """``df`` (a few numbers a row, already written) marked to be sent to every task if it has no more than ``most`` rows;
    a larger one is joined by a shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def jaccard_components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Components of the graph in which two documents link if their shingle sets do: doc_id, n_shingles, component_id.

    Words are runs without white space (space, 0x09 to 0x0D), A-Z as a-z; a text of fewer words than a shingle is one
    shingle. A null text and one without words have an empty set, which links with nothing. component_id is the
    smallest doc_id reachable, the document's own included. Rows of one doc_id are one vertex, whatever their texts, and
    so have one component; a null doc_id links with nothing and has a null component. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = written(describe(docs, rule))
    real = sets.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    owners = written(real.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep")))
    rep_ids = owners.select(F.col("rep").alias("doc_id")).distinct()
    reps = written(real.join(rep_ids, "doc_id", "left_semi").select("doc_id", "n", "head", "bits"))

    # 1. rough groups, from the first blocks of the lists
    groups = written(components(rough_edges(reps, rule)))
    group_of = groups.select(F.col("id").alias("doc_id"), F.col("component").alias("group"))
    # 2. exact links within groups, then between the parts of groups that were cut
    tokens = written(sets_of(docs, group_of, rule))
    grouped = tokens.join(sent_if_few(group_of), "doc_id").select("group", F.col("doc_id").alias("label"), "doc_id", "tokens")
    first = written(components(exact_edges(grouped, rule)))
    labels = written(relabelled(group_of.select("doc_id", F.col("doc_id").alias("label")), first))
    cut = written(group_of.join(labels, "doc_id").groupBy("group").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("group"))
    if not cut.isEmpty():
        # other chunks than before: members of one group by a hash of their ids
        mixed_up = labels.join(group_of, "doc_id").join(cut, "group", "left_semi").join(tokens, "doc_id")
        second = components(exact_edges(mixed_up.select("group", "label", "doc_id", "tokens", F.xxhash64("doc_id").alias("tie")), rule, "tie"))
        labels = written(relabelled(labels, second))

    # 3. every prefix list, for pairs between different components
    common_tokens = reps.select(F.explode("head").alias("token")).groupBy("token").count().filter(F.col("count") >= FREQUENT)
    frequent = np.sort(np.array([r.token for r in common_tokens.orderBy(F.desc("count"), "token").limit(MAX_FREQUENT).collect()], np.int64).view(np.uint64))
    listed = written(partnered(prefixes(docs.filter(F.col("doc_id").isNotNull()), rule, frequent), rule))
    # lists too long for one task: no more than a LIST_CHUNK-th of the rows
    lengths = listed.groupBy("token").agg(F.count("*").alias("rows")).filter(F.col("rows") > LIST_CHUNK)
    lengths = sent_if_few(written(lengths))
    listed = listed.drop("often").join(lengths.select("token", F.lit(True).alias("often")), "token", "left").withColumn("often", F.coalesce("often", F.lit(False)))
    kept = written(reps.select("doc_id").join(labels, "doc_id", "left").select("doc_id", F.coalesce("label", "doc_id").alias("label")))
    labelled = written(partnered(listed.join(sent_if_few(kept), "doc_id").select("token", "n", "doc_id", "pos", "often", "label"), rule, labels=True))
    long = labelled.filter("often").groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("rows")).filter("lo <> hi").select("token", "rows")
    lists = labelled.filter("not often").withColumn("rows", F.lit(1).cast("bigint")).unionByName(labelled.filter("often").join(sent_if_few(written(long)), "token"))
    pairs = written(list_pairs(lists.join(reps.select("doc_id", "bits"), "doc_id"), rule))
    ids = pairs.select(F.col("u").alias("doc_id")).unionAll(pairs.select(F.col("v").alias("doc_id")))
    links = written(verified(pairs, sets_of(docs, ids, rule), rule))
    by_id = kept.select(F.col("doc_id").alias("id"), "label")
    edges = links.join(by_id.select(F.col("id").alias("u"), F.col("label").alias("a")), "u").join(by_id.select(F.col("id").alias("v"), F.col("label").alias("b")), "v")
    edges = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    # rows of one doc_id with different sets: the labels of these are one vertex
    several = written(sets.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("n", "s1", "s2")).alias("lo"), F.max(F.struct("n", "s1", "s2")).alias("hi")).filter("lo <> hi").select("doc_id"))
    if not several.isEmpty():
        of_doc = real.join(several, "doc_id", "left_semi").join(owners, ["n", "s1", "s2"]).join(by_id.select(F.col("id").alias("rep"), "label"), "rep").select("doc_id", "label").distinct()
        edges = edges.unionAll(of_doc.join(of_doc.groupBy("doc_id").agg(F.min("label").alias("v")), "doc_id").select(F.col("label").alias("u"), "v"))
    last = components(edges)
    labels = relabelled(labels.unionAll(new_vertices(last, labels)), last)

    whole = owners.join(labels.withColumnRenamed("doc_id", "rep"), "rep", "left").select("n", "s1", "s2", F.coalesce("label", "rep").alias("component"))
    out = sets.select("doc_id", "n", "s1", "s2").join(whole, ["n", "s1", "s2"], "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    if several.isEmpty():
        return out
    # an empty set takes the component of its doc_id's other rows
    least = out.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("least"))
    return out.join(least, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("least", "component_id").alias("component_id"))


def new_vertices(found: DataFrame, labels: DataFrame) -> DataFrame:
    """Vertices of ``found`` that no label knows: documents outside all groups, which are their own labels."""
    return found.join(labels.select(F.col("label").alias("id")).distinct(), "id", "left_anti").select(F.col("id").alias("doc_id"), F.col("id").alias("label"))
