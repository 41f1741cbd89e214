"""Personal data by a skip-chain conditional random field (operator 5).

Exact patterns find the plain cases. The field labels the tokens around them: tokens in text order form chains, and
tokens of one document that repeat each other (the same letters and digits, or the same last seven digits) share a
potential, so that a number stated once with all its marks carries its label to a bare repetition far away. Weights are
fitted by pseudo-likelihood on a bounded sample in which the patterns give the labels; loopy message passing gives each
token's marginals over the whole document. The field only adds spans; those of the patterns stay.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.jobs import drawn, pieces

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
#: Documents that training draws at most, and the longest text among them.
TRAIN_DOCS, TRAIN_CHARS = 4000, 50_000
#: A span is added if every token of it has its label with this probability.
SURE = 0.95
FEATURE_BITS = 12
ROUNDS = 12

_domain = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never begins within digits: then the digits before it would have matched with it
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_digits = re.compile(r"[^0-9]+")
_sign = re.compile(r"[0-9@]")
_token = re.compile(r"\S+")
_strip = "\"'`,;:!?.<>[]{}*#$%&|"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the exact patterns, by kind and then by start: the leftmost matches of each kind that do not overlap."""
    out: list[tuple[str, int, int]] = []
    if not _sign.search(text):
        return out
    at, taken = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > taken and text[begin - 1] in _local:
            begin -= 1
        m = _domain.match(text, at + 1) if begin < at else None
        if m:
            out.append(("email", begin, m.end()))
            taken = m.end()
            at = text.find("@", taken)
        else:
            taken = at + 1
            at = text.find("@", at + 1)
    out += [("ip", m.start(), m.end()) for m in _ip.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _card.finditer(text):
        digits = _digits.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _phone.finditer(text) if 9 <= len(_digits.sub("", m.group())) <= 15]
    return out


def shape(token: str) -> str:
    """Character classes of a token, digits counted, letters in runs."""
    out = re.sub(r"[0-9]", "9", token[:48])
    return re.sub(r"[^\W\d_]+", "a", out)


def bucket(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode("utf-8", "replace"), digest_size=4).digest()) >> (32 - FEATURE_BITS)


class Sites:
    """The tokens of one text that can be personal data: those with a digit or an @ sign; any other has no such label."""

    def __init__(self, text: str):
        self.spans, self.cores = [], []
        for m in _token.finditer(text):
            core = m.group().strip(_strip) if _sign.search(m.group()) else ""
            if core and _sign.search(core):
                begin = m.start() + m.group().index(core)
                self.spans.append((begin, begin + len(core)))
                self.cores.append(core)
        n = len(self.spans)
        #: chain: the next token, if only white space and marks lie between
        self.chain = [(i, i + 1) for i in range(n - 1) if self.spans[i + 1][0] - self.spans[i][1] <= 4 and "\n" not in text[self.spans[i][1] : self.spans[i + 1][0]]]
        #: skip: the next token that repeats this one, in the letters and digits or in the last seven digits
        self.skip, last = [], {}
        for i, core in enumerate(self.cores):
            plain = re.sub(r"[\W_]+", "", core).lower()
            digits = _digits.sub("", core)
            for key in {("same", plain), ("digits", digits[-7:]) if len(digits) >= 7 else ("same", plain)}:
                if len(plain) >= 3:
                    if key in last:
                        self.skip.append((last[key], i))
                    last[key] = i
        self.skip = sorted(set(self.skip) - set(self.chain))

    def features(self) -> list[list[int]]:
        shapes = [shape(c) for c in self.cores]
        before, after = {b: a for a, b in self.chain}, dict(self.chain)
        out = []
        for i, core in enumerate(self.cores):
            digits = _digits.sub("", core)
            names = ["bias", f"shape={shapes[i]}", f"digits={min(len(digits), 20)}", f"at={core.count('@')}", f"dots={core.count('.')}", f"plus={core[0] == '+'}", f"letters={any(c.isalpha() for c in core)}"]
            if 13 <= len(digits) <= 19:
                names.append(f"luhn={luhn(digits)}")
            if core.count(".") == 3 and core.replace(".", "").isdigit():
                names.append(f"octets={all(int(p or 256) <= 255 for p in core.split('.'))}")
            if core.count("@") == 1:
                names.append(f"address={bool(_domain.fullmatch(core.split('@')[1]))}")
            left, right = before.get(i), after.get(i)
            names += [f"left={shapes[left] if left is not None else ''}", f"right={shapes[right] if right is not None else ''}"]
            out.append([bucket(n) for n in names])
        return out

    def labels(self, spans: list[tuple[str, int, int]]) -> list[int]:
        out = []
        for a, b in self.spans:
            kinds = [LABELS.index(k) for k, s, e in spans if s < b and a < e]
            out.append(kinds[0] if kinds else 0)
        return out


def lessons(text: str) -> np.ndarray:
    """What training reads of a text: for each token with a known label the numbers of features, chain and skip neighbours,
    the label, and then these: features, labels of chain neighbours (twice, and one if they come before), of repetitions.

    A token that no pattern covers though it repeats one that some pattern does may be a miss of the patterns: its label
    counts as unobserved, so it is neither learned from nor a neighbour.
    """
    sites = Sites(text)
    if not sites.spans:
        return np.zeros(0, np.int32)
    labels, found = sites.labels(base_spans(text)), sites.features()
    known = np.ones(len(labels), bool)
    for a, b in sites.skip:
        if (labels[a] == 0) != (labels[b] == 0):
            known[a if labels[a] == 0 else b] = False
    near: list[list[int]] = [[] for _ in labels]
    again: list[list[int]] = [[] for _ in labels]
    for a, b in sites.chain:
        if known[a] and known[b]:
            near[a].append(2 * labels[b]), near[b].append(2 * labels[a] + 1)
    for a, b in sites.skip:
        if known[a] and known[b]:
            again[a].append(labels[b]), again[b].append(labels[a])
    out = []
    for i in np.flatnonzero(known).tolist():
        out += [len(found[i]), len(near[i]), len(again[i]), labels[i], *found[i], *near[i], *again[i]]
    return np.array(out, np.int32)


def unpacked(packed: np.ndarray) -> Iterator[tuple[np.ndarray, int, list[tuple[int, bool]], list[int]]]:
    """(features, label, chain neighbours and whether they come before, repetitions) of each token of ``lessons``."""
    at = 0
    while at < len(packed):
        a, b, c, label = packed[at : at + 4].tolist()
        at += 4
        own, near, again = packed[at : at + a], packed[at + a : at + a + b].tolist(), packed[at + a + b : at + a + b + c].tolist()
        yield own, label, [(x // 2, x % 2 == 1) for x in near], again
        at += a + b + c


class SkipChain:
    """Weights: features x labels, potentials of chain edges and of skip edges (labels x labels), all learned."""

    def __init__(self, seed: int = 3):
        n = len(LABELS)
        self.unary = np.zeros((1 << FEATURE_BITS, n))
        self.chain = np.zeros((n, n))
        self.skip = np.zeros((n, n))
        self.seed = seed

    def fit(self, texts: list[str], **how) -> SkipChain:
        return self.learn([row for text in texts for row in unpacked(lessons(text))], **how)

    def learn(self, rows: list[tuple], epochs: int = 12, rate: float = 0.3, decay: float = 1e-4, hidden: float = 0.5) -> SkipChain:
        """Pseudo-likelihood over the ``lessons`` of texts: every token's label given the labels of its neighbours.

        All pairs of repetitions teach the skip potential, those that agree as those that don't. As a token's own form
        mostly tells its label, that form is hidden in a share of the steps, so that the potential learns what a repetition
        says by itself.
        """
        rng = np.random.default_rng(self.seed)
        for epoch in range(epochs):
            step = rate / (1 + epoch)
            for i in rng.permutation(len(rows)):
                at, label, near, again = rows[i]
                hide = bool(again) and rng.random() < hidden
                logits = np.zeros(len(LABELS)) if hide else self.unary[at].sum(0)
                for other, reverse in () if hide else near:
                    logits = logits + (self.chain[other] if reverse else self.chain[:, other])
                for other in again:
                    logits = logits + self.skip[other]
                error = np.exp(logits - logits.max())
                error /= error.sum()
                error[label] -= 1
                for other in again:
                    self.skip[other] -= step * (error + 10 * decay * self.skip[other])
                if hide:
                    continue
                self.unary[at] -= step * (error + decay * self.unary[at])
                for other, reverse in near:
                    if reverse:
                        self.chain[other] -= step * error
                    else:
                        self.chain[:, other] -= step * error
            self.skip = (self.skip + self.skip.T) / 2  # a repetition has no direction
        return self

    def marginals(self, sites: Sites) -> np.ndarray:
        """Loopy sum-product over chain and skip edges; exact where the graph has no cycle."""
        unary = np.stack([self.unary[at].sum(0) for at in sites.features()])
        edges = [(a, b, self.chain) for a, b in sites.chain] + [(a, b, self.skip) for a, b in sites.skip]
        belief = unary
        if edges:
            a, b = np.array([e[0] for e in edges]), np.array([e[1] for e in edges])
            weights = np.stack([e[2] for e in edges])
            forth, back = np.zeros((len(edges), len(LABELS))), np.zeros((len(edges), len(LABELS)))
            for _ in range(ROUNDS):
                belief = unary.copy()
                np.add.at(belief, b, forth), np.add.at(belief, a, back)
                new_forth = log_sum(weights + (belief[a] - back)[:, :, None], 1)
                new_back = log_sum(weights + (belief[b] - forth)[:, None, :], 2)
                new_forth -= new_forth.max(1, keepdims=True)
                new_back -= new_back.max(1, keepdims=True)
                moved = max(np.abs(new_forth - forth).max(), np.abs(new_back - back).max())
                forth, back = 0.5 * forth + 0.5 * new_forth, 0.5 * back + 0.5 * new_back
                if moved < 1e-3:
                    break
            belief = unary.copy()
            np.add.at(belief, b, forth), np.add.at(belief, a, back)
        belief = np.exp(belief - belief.max(1, keepdims=True))
        return belief / belief.sum(1, keepdims=True)

    def more_spans(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Spans of adjacent tokens with one sure label that touch no span of the patterns."""
        sites = Sites(text)
        if not sites.spans:
            return []
        chances = self.marginals(sites)
        best = chances.argmax(1)
        linked, out, taken = set(sites.chain), [], sorted((s, e) for _, s, e in base)
        starts = np.array([s for s, _ in taken], np.int64)
        i = 0
        while i < len(best):
            j = i
            while (j, j + 1) in linked and best[j + 1] == best[i]:
                j += 1
            a, b = sites.spans[i][0], sites.spans[j][1]
            at = int(np.searchsorted(starts, b))
            free = not taken or not any(s < b and a < e for s, e in taken[max(0, at - 8) : at])
            if best[i] and free and chances[i : j + 1, best[i]].min() >= SURE:
                out.append((LABELS[best[i]], a, b))
            i = j + 1
        return out


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


def joined(spans: list[tuple[str, int, int]]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (order[x[0]], x[1])))


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> SkipChain:
    """Fit the field on at most ``train_docs`` different texts with a digit or an @ sign, drawn by a hash of the text."""
    held = docs.filter(F.col("text").rlike("[0-9@]") & (F.length("text") <= TRAIN_CHARS)).select("text")
    read = lambda batch: [pa.array([lessons(t).tobytes() for t in batch.column(0).to_pylist()], pa.binary())]
    return SkipChain().learn([row for r in drawn(held, train_docs, read, "lessons binary") for row in unpacked(np.frombuffer(r.lessons, np.int32))])


def spans_of(text: str, model: SkipChain) -> tuple[list, list]:
    """(spans of the patterns, spans that the field adds)."""
    if not text or not _sign.search(text):
        return [], []
    base = base_spans(text)
    return base, model.more_spans(text, base)


def find(docs: DataFrame, model: SkipChain | None = None) -> DataFrame:
    """Personal data in every whole text: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and base_sha256 are of the patterns' spans; ``spans`` has all. Offsets are code points, ends exclusive.
    A null text counts as empty: no spans, the hash of the empty string. A null doc_id stays null; repeated rows are
    searched each; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in itertools.chain.from_iterable(map(pieces, batches)):
            counts, hashes, spans = np.zeros((batch.num_rows, 5), np.int64), [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                base, more = spans_of(text, known)
                for k, _, _ in base:
                    counts[i, KINDS.index(k)] += 1
                counts[i, 4] = len(more)
                hashes.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(base + more))
            columns = [batch.column(0), *(pa.array(counts[:, j]) for j in range(4)), pa.array(hashes, pa.string()), pa.array(spans, pa.string()), pa.array(counts[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return docs.mapInArrow(run, schema)


def hidden(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans go together, by the first kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
            at = b
        elif b > at:
            at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: SkipChain | None = None) -> DataFrame:
    """``docs`` with all spans of ``text`` replaced by <EMAIL>, <IP>, <CARD> or <PHONE>; nulls and other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in itertools.chain.from_iterable(pieces(b, at) for b in batches):
            texts = [t if t is None else hidden(t, sum(spans_of(t, known), [])) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
