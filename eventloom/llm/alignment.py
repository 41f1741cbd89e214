"""Alignment of two tokenizers over the same bytes (operator 11).

Each text has two ascending lists of byte offsets where tokens end. The shorter list drives a galloping search into the
longer one: steps double until they pass the wanted end, then the last step is searched by halving. Ends that both share
cut the tokens into groups; within a group the differences of ranks tell which tokens overlap.

There are places where both tokenizers begin a new token whatever stands around: a single space or line break between two
visible characters, and the end of a Latin word before a mark. Texts are cut there, and a cut is tokenised and aligned
once for as long as a worker remembers it. Tokens whose ranges end together are linked; as one of the two is a suffix of
the other, the pairs of ids that can be linked are listed from the vocabularies alone (some hundred thousand), whatever
the corpus. Counts of links over the corpus are sent to all tasks within that bound.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.bpe import byte_symbols
from eventloom.llm.jobs import pieces, written
from eventloom.llm.piece_bpe import LATIN, NORMAL, SPACE, PieceBpe

#: Bytes of cuts with their groups and links that a worker keeps at hand; beyond it the memory is emptied.
REMEMBERED_BYTES = 160_000_000
#: How the byte-level vocabulary's words are cut.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Visible characters, but for the mark of a space in pieces, and marks that are neither letters nor digits.
SEEN, MARK = f"[^\\s{SPACE}]", r"[!-/:-@\[-`{-~]"
#: What may follow a cut that ends in a visible character.
NEXT = f"(?= {SEEN}|\n|\\Z)"
CUT = re.compile(
    f" ?[{LATIN}]+(?=(?:{MARK}| {SEEN}|\n|\\Z))"  # a word
    f"|{MARK}+{NEXT}"
    f"|(?<={SEEN})\n(?={SEEN})"
    f"|(?s:.+?)(?:(?<={SEEN}){NEXT}|(?<=[{LATIN}])(?={MARK})|(?<={SEEN}\n)(?={SEEN})|\\Z)"  # anything else, up to the next such place
)


def common_ends(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Indices (i, j) with a[i] == b[j], of two ascending lists."""
    if len(a) > len(b):
        return [(i, j) for j, i in common_ends(b, a)]
    out, low, n = [], 0, len(b)
    for i, wanted in enumerate(a):
        high, step = low, 1
        while high < n and b[high] < wanted:
            low, high, step = high + 1, high + step, step * 2
        low = bisect_left(b, wanted, low, min(high, n))
        if low == n:
            break
        if b[low] == wanted:
            out.append((i, low))
            low += 1
    return out


def overlap_ranges(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """For each token of ``a`` the tokens first to last (exclusive) of ``b`` that share bytes with it.

    Within a group no inner ends agree, so a token's range goes from the rank of its beginning among the ends of ``b`` to
    the rank of its end.
    """
    out, at_a, at_b = [], 0, 0
    for i, j in common_ends(a, b):
        rank = at_b
        for k in range(at_a, i + 1):
            first, rank = rank, bisect_left(b, a[k], rank, j)
            out.append((first, rank + 1))
        at_a, at_b = i + 1, j + 1
    return out


class Aligner:
    """Both tokenizers, what they make of a cut, and the pairs of ids that can be linked."""

    def __init__(self, byte_spec: str, piece_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.bytewise = Tokenizer.from_str(byte_spec)
        self.bytewise.encode_special_tokens = True
        self.bytewise.no_truncation(), self.bytewise.no_padding()
        self.piecewise = PieceBpe(piece_model)
        byte = {s: i for i, s in enumerate(byte_symbols())}
        vocabulary = json.loads(byte_spec)["model"]["vocab"]
        self.a_bytes = {i: bytes(byte[c] for c in token) for token, i in vocabulary.items()}
        #: the same vocabulary for ASCII, where both libraries cut words alike and this one is three times as fast
        self.plain = tiktoken.Encoding("cuts", pat_str=WORDS, mergeable_ranks={t: i for i, t in self.a_bytes.items()}, special_tokens={})
        p = self.piecewise
        self.b_bytes = {i: piece.replace(SPACE, " ").encode() for i, piece in enumerate(p.piece) if p.kind[i] == NORMAL}
        self.b_bytes |= {i: bytes([b]) for b, i in enumerate(p.byte_id)}
        self.a_length = [len(self.a_bytes.get(i, b"")) for i in range(max(self.a_bytes) + 1)]
        self.b_length = [len(self.b_bytes.get(i, b"")) for i in range(len(p.piece))]
        self.id_text = [str(i) for i in range(max(len(self.a_length), len(self.b_length)))]
        self.pairs = self.linkable()
        self.pair_b = (self.pairs & 0xFFFF).astype(np.int64)
        self.number = {k: i for i, k in enumerate(self.pairs.tolist())}
        if any(re.search(f"[{LATIN}]{MARK}|.\n|\n.|[^{SPACE}]{SPACE}", piece) for piece in p.id_of):
            raise ValueError("a piece goes on past the places where texts are cut")
        self.known: dict[str, tuple | None] = {}
        self.remembered = 0

    def linkable(self) -> np.ndarray:
        """Keys (A id * 65536 + B id) of all pairs of which one is a suffix of the other, ascending."""
        if len(self.piecewise.piece) > 1 << 16:
            raise ValueError("pair keys hold piece ids below 65536")
        by_a, by_b = {}, {}
        for by, tokens in ((by_a, self.a_bytes), (by_b, self.b_bytes)):
            for i, t in tokens.items():
                by.setdefault(t, []).append(i)
        keys = {a << 16 | b for a, t in self.a_bytes.items() for k in range(len(t)) for b in by_b.get(t[k:], ())}
        keys |= {a << 16 | b for b, t in self.b_bytes.items() for k in range(1, len(t)) for a in by_a.get(t[k:], ())}
        return np.array(sorted(keys), np.int64)

    def cuts(self, text: str) -> list[str]:
        """Parts of a space and the text; every part begins a token of either tokenizer."""
        return CUT.findall(" " + text)

    def bytewise_ids(self, cuts: list[str]) -> Iterator[tuple[str, list[int]]]:
        ascii_, other = [c for c in cuts if c.isascii()], [c for c in cuts if not c.isascii()]
        yield from ((c, self.plain.encode_ordinary(c)) for c in ascii_)
        yield from ((c, e.ids) for c, e in zip(other, self.bytewise.encode_batch(other, add_special_tokens=False), strict=True))

    def learn(self, cuts: list[str]) -> None:
        """Tokenise and align cuts: number of A tokens, numbers of the linked pairs (32 bits each), groups as text. None where
        either tokenizer does not give back the bytes."""
        piecewise, a_length, b_length, shown_id, number = self.piecewise, self.a_length, self.b_length, self.id_text, self.number
        for cut, a in self.bytewise_ids(cuts):
            b = [i for unit in piecewise.cuts.findall(cut.replace(" ", SPACE)) for i in piecewise.tokens(unit)]
            ends_a, ends_b = [*accumulate([a_length[i] for i in a])], [*accumulate([b_length[i] for i in b])]
            # a marked space in the text itself is read as a space: other bytes, and fewer of them
            if not ends_a[-1] == ends_b[-1] == len(cut.encode()):
                self.known[cut] = None
                continue
            of_a, of_b = [shown_id[i] for i in a], [shown_id[i] for i in b]
            groups, links, at_a, at_b = [], [], 0, 0
            for i, j in common_ends(ends_a, ends_b):
                if i == at_a and j == at_b:
                    groups.append(of_a[i] + "|" + of_b[j])
                else:
                    groups.append(",".join(of_a[at_a : i + 1]) + "|" + ",".join(of_b[at_b : j + 1]))
                links.append(number[a[i] << 16 | b[j]])
                at_a, at_b = i + 1, j + 1
            shown = ";".join(groups)
            self.known[cut] = len(a), array("I", links).tobytes(), shown
            self.remembered += 2 * len(cut) + len(shown) + 4 * len(links) + 350

    def align(self, cuts: list[str]) -> tuple[int, int, np.ndarray, str]:
        """Numbers of A and B tokens, numbers of the linked pairs and groups as text, for all cuts of a text: nothing of an
        empty one or one that does not come back as it was."""
        found = [self.known[cut] for cut in cuts]
        if not found or None in found:
            return 0, 0, numbers(b""), ""
        links, shown = numbers(b"".join([f[1] for f in found])), ";".join([f[2] for f in found])
        n_a = sum([f[0] for f in found])
        # every group has as many commas as tokens beyond one of either kind
        return n_a, shown.count(",") + 2 * len(links) - n_a, links, shown

    def align_all(self, texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, str]]:
        if self.remembered > REMEMBERED_BYTES:
            self.known, self.remembered = {}, 0
        cut = [self.cuts(t) if t else [] for t in texts]
        self.learn(list(set(chain.from_iterable(cut)).difference(self.known)))
        return map(self.align, cut)


@functools.lru_cache(1)
def aligner_of(byte_spec: str, piece_model: bytes) -> Aligner:
    """One aligner a worker process, so that its tasks share what it remembers."""
    return Aligner(byte_spec, piece_model)


def numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32)


def counted(links: list[np.ndarray]) -> Iterator[tuple[bytes, bytes]]:
    """For each text the different pairs among its links, and how often each occurs."""
    lengths = [len(x) for x in links]
    keys, times = np.unique(np.repeat(np.arange(len(links), dtype=np.int64), lengths) << 32 | np.concatenate(links), return_counts=True)
    bounds = np.searchsorted(keys, np.arange(len(links) + 1, dtype=np.int64) << 32).tolist()
    pairs, times = keys.astype(np.uint32), times.astype(np.uint32)
    for a, b in zip(bounds, bounds[1:], strict=False):
        yield pairs[a:b].tobytes(), times[a:b].tobytes()


def link_counts(aligned: DataFrame, n_pairs: int) -> np.ndarray:
    """Links of each linkable pair over all documents. Every task adds up its own, so at most one row a pair and task is
    shuffled; the driver gets one number a pair, whose number the vocabularies bound."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_pairs, np.int64)
        for batch in batches:
            pairs = np.concatenate([numbers(x) for x in batch.column(0).to_pylist()] or [numbers(b"")])
            times = np.concatenate([numbers(x) for x in batch.column(1).to_pylist()] or [numbers(b"")])
            total += np.bincount(pairs, times, n_pairs).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["pair", "n"])

    rows = aligned.select("pairs", "times").mapInArrow(added, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_pairs, np.int64)
    out[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return out


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, keep_groups: bool = False) -> DataFrame:
    """Align the tokens that a byte-level BPE (A) makes of a space and the text, and a sentencepiece model (B) of the text.

    Returns doc_id, n_a, n_b (tokens), n_groups (between ends that both share), n_links (pairs of tokens that end together),
    n_best (links whose pair of ids is, over the corpus, the most frequent of its B id; ties included), count_sum (of the
    links' corpus counts), groups_sha256 (of ``a1,a2|b1;a3|b2,b3``), n_overlaps (pairs of tokens that share bytes) and,
    with ``keep_groups``, the groups as text. Null and empty texts, and those of which a tokenizer does not give back the
    bytes (such as texts with U+2581, which is read as a space), have no tokens: zeros and an empty digest. Strings of
    special tokens are plain text. Rows with a null or repeated doc_id are aligned each; other columns are ignored.
    """
    with open(byte_path, encoding="utf-8") as f, open(piece_path, "rb") as g:
        spec, model = f.read(), g.read()
    context = docs.sparkSession.sparkContext
    sent = context.broadcast((spec, model))
    n_pairs = len(aligner_of(spec, model).pairs)
    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_overlaps bigint, groups_sha256 string, pairs binary, times binary" + ", groups string" * keep_groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(*sent.value)
        for batch in batches:
            for part in pieces(batch):
                found = list(aligner.align_all(part.column(1).to_pylist()))
                rows = []
                for (a, b, links, shown), pairs in zip(found, counted([f[2] for f in found]), strict=True):
                    # a group of m and k tokens, whose inner ends all differ, has m + k - 1 overlapping pairs
                    digest = hashlib.sha256(shown.encode()).hexdigest() if shown else ""
                    rows.append((a, b, len(links), len(links), a + b - len(links), digest, *pairs, shown))
                kinds = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary(), pa.string()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "pairs", "times", "groups"]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns][: 9 + keep_groups], names[: 9 + keep_groups])

    aligned = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema))
    counts = link_counts(aligned, n_pairs)
    best = np.zeros(1 << 16, np.int64)
    pair_b = aligner_of(spec, model).pair_b
    np.maximum.at(best, pair_b, counts)
    of_pairs = context.broadcast((counts, counts == best[pair_b]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, is_best = of_pairs.value
        for batch in batches:
            n_best, total = [], []
            for pairs, times in zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist(), strict=True):
                p, t = numbers(pairs), numbers(times).astype(np.int64)
                n_best.append(int(t[is_best[p]].sum()))
                total.append(int((t * counts[p]).sum()))
            rest = [n for n in batch.schema.names if n not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], [*rest, "n_best", "count_sum"])

    result = schema.replace(", pairs binary, times binary", "") + ", n_best bigint, count_sum bigint"
    out = aligned.mapInArrow(scored, result)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps", *["groups"] * keep_groups)
