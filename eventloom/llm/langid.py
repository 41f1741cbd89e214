"""Language identification by averaged hashed subword embeddings and a linear softmax (operator 4).

A text's features are its runs of three and four bytes (letters folded, everything that is no letter a blank), each
hashed to a bucket with an embedding; the text is the mean of its embeddings. Training is stochastic gradient descent
in numpy on a bounded sample of rows; a held-back part of that sample fits the temperature of the scores and, per
language, the score under which a prediction is rejected. As the classifier is linear after the mean, scoring needs
only each bucket's logits, which are a table of bucket count x languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.arrays import Slice, slices
from eventloom.llm.jobs import drawn

BUCKET_BITS = 15
#: Rows that training draws at most, and the longest text among them (longer ones are scored, but not learned from).
TRAIN_ROWS, TRAIN_CHARS = 2400, 50_000
#: Bytes of text that training looks at at once, as it runs on the driver.
TRAIN_SLICE = 1 << 17
UNKNOWN = "und"
#: Of the held-back rows that are right, the share whose score a language's rejection bound lets pass.
ACCEPTED_SHARE = 0.99

_fold = np.arange(256, dtype=np.uint32)
_fold[:128] = 32
_fold[65:91] = _fold[97:123] = np.arange(97, 123)


def letters(part: Slice) -> np.ndarray:
    """The bytes with letters folded to small ones and all other ASCII bytes blank."""
    folded = _fold[part.data]
    if len(folded) > 1:
        capital = (part.data[:-1] == 0xC3) & (part.data[1:] >= 0x80) & (part.data[1:] <= 0x9E)
        folded[1:][capital] += 0x20
    return folded


def subwords(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every subword of a slice and the index of its text."""
    folded = letters(part)
    owner = np.repeat(np.arange(len(part)), np.diff(part.offsets))
    if len(folded) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, c = folded[:-2], folded[1:-1], folded[2:]
    three = a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + c * np.uint32(0xC2B2AE3D)
    four = three[:-1] * np.uint32(0x27D4EB2F) + folded[3:] * np.uint32(0x165667B1)
    inner = (b != 32) & (c != 32)
    three_whole = np.flatnonzero(inner & (owner[:-2] == owner[2:]))
    four_whole = np.flatnonzero(inner[:-1] & (owner[:-3] == owner[3:]))
    shift = np.uint32(32 - BUCKET_BITS)
    buckets = [(h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> shift for h in (three[three_whole], four[four_whole])]
    return np.concatenate(buckets).astype(np.int64), np.concatenate([owner[three_whole], owner[four_whole]])


def has_letter(part: Slice) -> np.ndarray:
    """Whether each text has a letter of any script."""
    data = part.data
    ascii_letter = ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122))
    sums = np.append(0, np.cumsum(ascii_letter))
    found = sums[part.offsets[1:]] > sums[part.offsets[:-1]]
    for i in np.flatnonzero(~found):
        text = data[part.offsets[i] : part.offsets[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(ch.isalpha() for ch in text)
    return found


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray  # buckets x languages, float32
    bias: np.ndarray
    temperature: float
    bounds: np.ndarray  # per language, the least score that is accepted

    def probabilities(self, part: Slice) -> np.ndarray:
        buckets, owner = subwords(part)
        n = np.maximum(np.bincount(owner, minlength=len(part)), 1)
        total = np.stack([np.bincount(owner, self.logits[buckets, j], len(part)) for j in range(len(self.languages))], 1)
        return softmax((total / n[:, None] + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(texts: list[str], langs: list[str], dim: int = 16, epochs: int = 6, rate: float = 1.5, seed: int = 7) -> LanguageModel:
    """Fit embeddings, softmax, temperature and rejection bounds; the same rows give the same model."""
    languages = sorted(set(langs)) or [UNKNOWN]
    target = np.array([languages.index(x) for x in langs], np.int64)
    bags = []
    for part in slices(pa.array(texts, pa.large_string()), TRAIN_SLICE):
        buckets, owner = subwords(part)
        for i in range(len(part)):
            values, counts = np.unique(buckets[owner == i], return_counts=True)
            bags.append((values, (counts / max(counts.sum(), 1)).astype(np.float32)))
    rng = np.random.default_rng(seed)
    held = np.arange(len(bags)) % 5 == 4
    table = rng.normal(0, 0.1, (1 << BUCKET_BITS, dim)).astype(np.float32)
    weights, bias = rng.normal(0, 0.3, (dim, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)
    fitted = np.flatnonzero(~held)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(fitted):
            buckets, share = bags[i]
            mean = share @ table[buckets]
            error = softmax((mean @ weights + bias)[None])[0]
            error[target[i]] -= 1
            back = weights @ error
            weights -= step * 0.1 * np.outer(mean, error)
            bias -= step * 0.05 * error
            table[buckets] -= step * 5 * share[:, None] * back[None]
    logits = table @ weights
    temperature, bounds = 1.0, np.zeros(len(languages))
    check = np.flatnonzero(held)
    if len(check):
        raw = np.stack([bags[i][1] @ logits[bags[i][0]] + bias for i in check])
        loss = lambda t: -np.log(np.maximum(softmax(raw / t)[np.arange(len(check)), target[check]], 1e-9)).mean()
        temperature = float(min(np.geomspace(0.1, 10, 41), key=loss))
        scores = softmax(raw / temperature)
        best = scores.argmax(1)
        for j in range(len(languages)):
            right = scores[(best == j) & (target[check] == j), j]
            if len(right) >= 5:
                bounds[j] = np.quantile(right, 1 - ACCEPTED_SHARE)
    return LanguageModel(languages, logits.astype(np.float32), bias, temperature, bounds)


def fit(docs: DataFrame, learn_from, train_rows: int = TRAIN_ROWS) -> LanguageModel:
    """Train on at most ``train_rows`` different (lang, text) for which ``learn_from`` holds and neither is null."""
    known = docs.filter(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    rows = drawn(known.filter(F.length("text") <= TRAIN_CHARS), train_rows)
    return train([r.text for r in rows], [r.lang for r in rows])


def predict(docs: DataFrame, model: LanguageModel, columns: list) -> DataFrame:
    """``columns`` (of which one is text) with text replaced by lang_pred, score and accepted.

    The whole text is scored. A null text or one without any letter gets ``und`` with score 0 and isn't accepted;
    a text with letters too short for a subword gets the likeliest language by bias alone.
    """
    chosen = docs.select(*columns)
    kept = [c for c in chosen.columns if c != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**15 buckets x languages
    schema = ", ".join(f"`{c}` {chosen.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            names, scores, accepted = [], [], []
            for part in slices(batch.column(batch.schema.get_field_index("text"))):
                probability = known.probabilities(part)
                best = probability.argmax(1)
                score = probability[np.arange(len(part)), best]
                real = has_letter(part)
                names += [known.languages[j] if ok else UNKNOWN for j, ok in zip(best, real, strict=True)]
                scores.append(np.where(real, score, 0.0))
                accepted.append(real & (score >= known.bounds[best]))
            if names:
                columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
                found = [pa.array(names, pa.string()), pa.array(np.concatenate(scores), pa.float64()), pa.array(np.concatenate(accepted), pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns + found, [*kept, "lang_pred", "score", "accepted"])

    return chosen.mapInArrow(run, f"{schema}, lang_pred string, score double, accepted boolean")


def identify(docs: DataFrame, folds: int = 3, held_fold: int = 1) -> DataFrame:
    """Language of every document, learned from those whose crc32(doc_id) modulo ``folds`` is not ``held_fold``.

    Returns doc_id, held_out, lang_pred, score, accepted. Inputs of a prediction: the text alone. A null doc_id is
    not held out and isn't learned from. Without a labelled row every prediction is ``und``.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    model = fit(docs, F.coalesce(fold != held_fold, F.lit(False)))
    held = F.coalesce(fold == held_fold, F.lit(False)).alias("held_out")
    return predict(docs, model, [F.col("doc_id").cast("long").alias("doc_id"), held, "text"])
