"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata (operator 9).

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)): the pairwise interactions of all
features in time linear in their number. Each word occurrence is a feature of value 1 / n, so a text of any length has
the same scale; structure statistics are dense features, and so is the metadata that a score may use: the length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.arrays import Slice, slices, words
from eventloom.llm.jobs import drawn, share

BUCKET_BITS = 16
RANK = 6
#: Labelled rows that training draws at most, and the longest text among them.
TRAIN_ROWS, TRAIN_CHARS = 6000, 50_000
#: Bytes of text that are read at once for training, and held-back texts that are scored at once.
TRAIN_SLICE, HELD_BATCH = 1 << 17, 128
ACCEPT = 0.3
#: Deviations at which dense features are cut.
CLIP = 6.0

CLASSES = [
    ("capital", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", b"0123456789"), ("bar", b"|"), ("mark", b"#$%&*=~^_<>{}[]\\@"),
    ("end", b".!?"), ("shout", b"!"), ("comma", b",;:"), ("line", b"\n"), ("blank", b" \t"),
]
_class_of = np.zeros((256, len(CLASSES)), np.float64)
for _j, (_, _members) in enumerate(CLASSES):
    _class_of[list(_members), _j] = 1
DENSE = [name for name, _ in CLASSES] + ["capital_c3", "log_words", "word_length", "distinct", "repeated_pairs", "line_length", "log_chars", "short"]


def structure(part: Slice, found, repeats: np.ndarray) -> np.ndarray:
    """Structure statistics and metadata (the length) of each text, all of about unit scale."""
    lengths = np.maximum(np.diff(part.offsets), 1).astype(np.float64)
    out = np.zeros((len(part), len(DENSE)))
    sums = lambda x: np.diff(np.append(0, np.cumsum(x))[part.offsets])
    for j in range(len(CLASSES)):
        out[:, j] = sums(_class_of[part.data, j]) / lengths
    high = np.zeros(len(part.data))
    if len(high) > 1:
        high[1:] = (part.data[:-1] == 0xC3) & (part.data[1:] >= 0x80) & (part.data[1:] <= 0x9E)
    j = len(CLASSES)
    n = np.diff(found.bounds)
    out[:, j] = sums(high) / lengths
    out[:, j + 1] = np.log1p(n) / 8
    out[:, j + 2] = np.minimum(lengths / np.maximum(n, 1), 30) / 10
    out[:, j + 3 : j + 5] = repeats
    out[:, j + 5] = np.log1p(lengths / (1 + out[:, 7] * lengths)) / 8
    out[:, j + 6] = np.log1p(lengths) / 10
    out[:, j + 7] = n < 20
    return out


def repetition(found) -> np.ndarray:
    """Per text the share of distinct words and of word pairs that occur again."""
    out = np.zeros((len(found.bounds) - 1, 2))
    for i in range(len(out)):
        h = found.hashes[found.bounds[i] : found.bounds[i + 1]]
        if len(h) > 1:
            pairs = h[:-1] * np.uint64(3) + h[1:]
            out[i] = len(np.unique(h)) / len(h), 1 - len(np.unique(pairs)) / len(pairs)
    return out


def features(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, word bounds of each text, and dense features."""
    found = words(part)
    buckets = (found.hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    return buckets, found.bounds, structure(part, found, repetition(found))


@dataclass
class FactorisationMachine:
    bias: float
    word: np.ndarray  # buckets x (1 + RANK): weight and factors
    dense: np.ndarray  # dense features x (1 + RANK)
    centre: np.ndarray
    scale: np.ndarray
    slope: float = 1.0  # calibration
    shift: float = 0.0

    def scaled(self, dense: np.ndarray) -> np.ndarray:
        """Dense features in deviations of the training rows, cut at CLIP, in training as in scoring."""
        return np.clip((dense - self.centre) / self.scale, -CLIP, CLIP)

    def raw(self, buckets: np.ndarray, bounds: np.ndarray, dense: np.ndarray) -> np.ndarray:
        share = np.repeat(1 / np.maximum(np.diff(bounds), 1), np.diff(bounds))
        return self.bias + machine(self.word[buckets], share, share**2, bounds, self.scaled(dense), self.dense)[0]

    def scores(self, part: Slice) -> np.ndarray:
        return sigmoid(self.slope * self.raw(*features(part)) + self.shift)


def sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the rows of ``x`` from each bound to the next."""
    return np.diff(np.vstack([np.zeros((1, x.shape[1])), np.cumsum(x, 0, dtype=np.float64)])[bounds], axis=0)


def machine(rows: np.ndarray, value: np.ndarray, squared: np.ndarray, bounds: np.ndarray, x: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linear and pairwise terms of each text without bias, and the sums per factor that their gradient needs.

    ``value`` is the sum of a word's feature values in a text, ``squared`` the sum of their squares: every occurrence of a
    word is a feature of its own, of value 1 / n.
    """
    total = sums(rows * value[:, None], bounds) + x @ flat
    squares = sums(rows[:, 1:] ** 2 * squared[:, None], bounds) + x**2 @ flat[:, 1:] ** 2
    return total[:, 0] + 0.5 * (total[:, 1:] ** 2 - squares).sum(1), total


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def counted(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What training reads of every text: its different word buckets, how often each occurs, and its dense features."""
    for part in slices(column, TRAIN_SLICE):
        buckets, bounds, dense = features(part)
        for i in range(len(part)):
            found, counts = np.unique(buckets[bounds[i] : bounds[i + 1]], return_counts=True)
            yield found.astype(np.uint16), counts.astype(np.uint32), dense[i]


def train(texts: list[str], labels: list[int], **how) -> FactorisationMachine:
    return learn(list(counted(pa.array(texts, pa.large_string()))), labels, **how)


def learn(examples: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: list[int], epochs: int = 10, rate: float = 0.08, decay: float = 1e-4, batch: int = 32, seed: int = 5) -> FactorisationMachine:
    """Stochastic gradient descent over small batches of ``counted`` texts with adaptive steps; a fifth of the rows is held
    back to calibrate the scores.

    It runs on the driver: of each different word of a text it holds six bytes, all else is made for a batch at a time.
    ``examples`` is emptied.
    """
    y = np.array(labels, np.float64)
    dense = np.array([d for _, _, d in examples]).reshape(-1, len(DENSE))
    bounds = np.append(0, np.cumsum(np.array([len(a) for a, _, _ in examples], np.int64)))
    lengths = np.array([max(int(c.sum()), 1) for _, c, _ in examples], np.int64)  # words of each text
    at = np.concatenate([np.zeros(0, np.uint16), *(a for a, _, _ in examples)])
    times = np.concatenate([np.zeros(0, np.uint32), *(c for _, c, _ in examples)])
    examples.clear()
    rng = np.random.default_rng(seed)
    fitted = np.arange(len(y)) % 5 != 4
    model = FactorisationMachine(
        bias=float(np.log((y[fitted].sum() + 0.5) / ((1 - y[fitted]).sum() + 0.5))),
        word=np.hstack([np.zeros((1 << BUCKET_BITS, 1)), rng.normal(0, 0.05, (1 << BUCKET_BITS, RANK))]),
        dense=np.hstack([np.zeros((len(DENSE), 1)), rng.normal(0, 0.02, (len(DENSE), RANK))]),
        centre=dense[fitted].mean(0) if fitted.any() else np.zeros(len(DENSE)),
        scale=np.maximum(dense[fitted].std(0), 1e-3) if fitted.any() else np.ones(len(DENSE)),
    )
    x = model.scaled(dense)
    word, flat = model.word, model.dense
    seen_word, seen_flat = np.full(word.shape, 1e-2), np.full(flat.shape, 1e-1)

    def rows_of(texts_: np.ndarray):
        n = bounds[texts_ + 1] - bounds[texts_]
        own = np.append(0, np.cumsum(n))
        place, words_ = np.arange(own[-1]) + np.repeat(bounds[texts_] - own[:-1], n), np.repeat(lengths[texts_], n)
        return at[place].astype(np.int64), times[place] / words_, times[place] / words_**2, own, n

    for _ in range(epochs):
        order = rng.permutation(np.flatnonzero(fitted))
        for lo in range(0, len(order), batch):
            chosen = order[lo : lo + batch]
            buckets, v, q, own, n = rows_of(chosen)
            v, q, xi = v[:, None], q[:, None], x[chosen]
            rows = word[buckets]
            raw, total = machine(rows, v[:, 0], q[:, 0], own, xi, flat)
            error = sigmoid(model.bias + raw) - y[chosen]
            grad = np.hstack([v, v * np.repeat(total[:, 1:], n, 0) - q * rows[:, 1:]]) * np.repeat(error, n)[:, None]
            by = np.argsort(buckets, kind="stable")
            first = np.flatnonzero(np.append(True, buckets[by][1:] != buckets[by][:-1])) if len(by) else by
            if len(by):
                grad, touched = np.add.reduceat(grad[by], first, axis=0), buckets[by][first]
                seen_word[touched] += grad**2
                word[touched] -= rate * grad / np.sqrt(seen_word[touched])
            grad_flat = np.hstack([xi.T @ error[:, None], xi.T @ (error[:, None] * total[:, 1:]) - (xi**2).T @ error[:, None] * flat[:, 1:]]) + decay * flat
            seen_flat += grad_flat**2
            flat -= 0.5 * rate * grad_flat / np.sqrt(seen_flat)
            model.bias -= 0.01 * float(error.sum())
    held = np.flatnonzero(~fitted)
    if len(held) and 0 < y[held].mean() < 1:
        raw = []
        for lo in range(0, len(held), HELD_BATCH):
            chosen = held[lo : lo + HELD_BATCH]
            buckets, v, q, own, _ = rows_of(chosen)
            raw.append(model.bias + machine(word[buckets], v, q, own, x[chosen], flat)[0])
        raw = np.concatenate(raw)
        loss = lambda p: -(y[held] * np.log(sigmoid(p[0] * raw + p[1])) + (1 - y[held]) * np.log(1 - sigmoid(p[0] * raw + p[1]) + 1e-12)).mean()
        model.slope, model.shift = (float(v) for v in min(((a, b) for a in np.geomspace(0.2, 3, 25) for b in np.linspace(-2, 2, 17)), key=loss))
    return model


def fit(docs: DataFrame, labels: DataFrame, learn_from, train_rows: int = TRAIN_ROWS) -> FactorisationMachine:
    """Train on at most ``train_rows`` different labelled (text, label), drawn by a hash of them.

    ``labels`` has doc_id and quality (0 or 1, else ignored); of several labels of one document the smallest counts.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & learn_from).groupBy("doc_id").agg(F.min("quality").alias("label"))
    some = share(["doc_id"], train_rows, known.count())  # on both sides, so that no other text is joined or moved
    texts = docs.filter(some & learn_from & F.col("text").isNotNull() & (F.length("text") <= TRAIN_CHARS)).select("doc_id", "text")

    def read(batch: pa.RecordBatch) -> list[pa.Array]:
        found = list(counted(batch.column(1)))
        return [batch.column(0).cast(pa.int32()), *(pa.array([x[j].tobytes() for x in found], pa.binary()) for j in range(3))]

    rows = drawn(texts.join(known.filter(some), "doc_id").select("label", "text"), train_rows, read, "label int, at binary, times binary, dense binary")
    truth = [r.label for r in rows]
    rows = [(np.frombuffer(r.at, np.uint16), np.frombuffer(r.times, np.uint32), np.frombuffer(r.dense, np.float64)) for r in rows]
    return learn(rows, truth)


def score(docs: DataFrame, model: FactorisationMachine, columns: list) -> DataFrame:
    """``columns``, of which one is text, with text replaced by score and predicted.

    The whole text is scored, a null one as an empty one.
    """
    chosen = docs.select(*columns)
    kept = [c for c in chosen.columns if c != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**16 buckets x 7
    schema = ", ".join(f"`{c}` {chosen.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            scores = [known.scores(part) for part in slices(batch.column(batch.schema.get_field_index("text")))]
            if scores:
                found = np.concatenate(scores)
                columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found), pa.array((found >= ACCEPT).astype(np.int32))], [*kept, "score", "predicted"])

    return chosen.mapInArrow(run, f"{schema}, score double, predicted int")


def accepted(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """The rows of ``docs`` whose text scores ACCEPT or more, with all their columns; a null text is scored as an empty one."""
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            scores = [known.scores(part) for part in slices(batch.column(at))]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) >= ACCEPT))

    return docs.mapInArrow(run, docs.schema)


def learning_rows(folds: int = 5, held_fold: int = 0):
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    return F.coalesce(fold != held_fold, F.lit(False))


def assess(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0) -> DataFrame:
    """Quality score of every document, learned from labels whose crc32(doc_id) modulo ``folds`` is not ``held_fold``.

    Returns doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.3). Inputs of a score: the text and what is
    counted from it. A null doc_id is not held out.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    model = fit(docs, labels, learning_rows(folds, held_fold))
    held = F.coalesce(fold == held_fold, F.lit(False)).alias("held_out")
    return score(docs, model, [F.col("doc_id").cast("long").alias("doc_id"), held, "text"])
