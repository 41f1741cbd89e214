"""BPE encoding and decoding in batched numpy merge rounds (operator 8).

The merge work is done for many words at once: the symbols of all words lie in one flat array, each round looks up
the rank of every neighbouring pair by binary search over the sorted pair keys, takes the lowest rank of each word
and merges its occurrences. Words leave the array when no pair of theirs has a rank.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.jobs import pieces

NO_RANK = np.int32(1 << 30)
#: Characters of runs, ids and tokens that a worker keeps at hand; beyond it the memory is emptied and filled anew.
REMEMBERED_CHARS = 24_000_000
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary file whose words carry an end mark and no white space.

    Text is composed (NFC), lower-cased character by character and cut by the file's own pattern; special tokens are
    recognised in the raw text first. Decoding joins the tokens' strings by one space, as the file names no decoder.
    """

    def __init__(self, spec: str):
        described = json.loads(spec)
        model = described["model"]
        self.end = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        specials = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in specials.items()}
        self.specials = specials
        self.special_pattern = regex.compile("|".join(regex.escape(t) for t in specials)) if specials else None
        #: the first two characters of every special token: texts without any hold none
        self.special_marks = {t[:2] for t in specials}
        pattern = next(p["pattern"]["Regex"] for p in described["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(pattern)
        size = max(self.tokens) + 1
        self.id_text = [str(i) for i in range(size)]
        self.token_text = [self.tokens.get(i, "") for i in range(size)]
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int32)
        self.last = np.array([vocab[s + self.end] for s in symbols], np.int32)
        left, right, merged = [], [], []
        for pair in model["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left.append(vocab[a]), right.append(vocab[b]), merged.append(vocab[a + b])
        if size > 1 << 16:
            raise ValueError("pair keys hold ids below 65536")
        keys = np.array(left, np.uint32) << np.uint32(16) | np.array(right, np.uint32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int32), np.array(merged, np.int32)
        self.special_runs = {" " + t: (self.id_text[i], t) for t, i in specials.items()}
        self.known: dict[str, tuple[str, str]] = dict(self.special_runs)
        self.remembered = 0

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, by binary search over the sorted pair keys."""
        pair = left.astype(np.uint32) << np.uint32(16) | right.astype(np.uint32)
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], NO_RANK)

    def merge(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over the symbols of many words; ``owner`` is each symbol's word, in ascending order."""
        done_symbols, done_owner = [], []
        # rank[i]: rank of the pair of symbol i and the next one of its word
        rank = np.full(len(symbols), NO_RANK)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inside] = self.pair_ranks(symbols[inside], symbols[inside + 1])
        while len(symbols):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lengths = np.diff(np.append(first, len(symbols)))
            best = np.minimum.reduceat(rank, first)
            of_word = np.repeat(best, lengths)
            going = of_word < NO_RANK
            if not going.all():
                done_symbols.append(symbols[~going]), done_owner.append(owner[~going])
                symbols, owner, rank, of_word = symbols[going], owner[going], rank[going], of_word[going]
                if not len(symbols):
                    break
            hit = rank == of_word
            if (hit[1:] & hit[:-1]).any():
                # of overlapping occurrences (pairs of equal symbols in a run) every second one counts, from the left
                index = np.arange(len(hit))
                run_start = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), index, 0))
                hit &= (index - run_start) % 2 == 0
            at = np.flatnonzero(hit)
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            now = at - np.arange(len(at))
            changed = np.concatenate([now, now[now > 0] - 1])
            rank[changed] = NO_RANK
            changed = changed[changed < len(symbols) - 1]
            changed = changed[owner[changed] == owner[changed + 1]]
            rank[changed] = self.pair_ranks(symbols[changed], symbols[changed + 1])
        if not done_symbols:
            return symbols, owner
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return symbols[order], owner[order]

    def word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and bounds: word i has ids[bounds[i]:bounds[i + 1]]."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[data[ends]]
        ids, owner = self.merge(symbols, np.repeat(np.arange(len(words), dtype=np.int32), lengths))
        return ids, np.searchsorted(owner, np.arange(len(words) + 1))

    def cut(self, text: str) -> list[str]:
        """Words of a normalised text without special tokens."""
        return self.pattern.findall(text)

    def learn(self, runs: set[str]) -> None:
        """Encode runs without white space; remember the ids and tokens of each, and of its words, as text."""
        known, need, several = self.known, set(), []
        for run in runs:
            if run in known:
                continue
            if run.isalpha():
                need.add(run)
                continue
            body, end = run[:-1], run[-1]
            parts = [body, end] if body.isalpha() and not end.isalnum() else self.cut(run)
            several.append((run, parts))
            need.update([p for p in parts if p not in known])
        words = list(need)
        if words:
            ids, bounds = self.word_ids(words)
            ids, bounds = ids.tolist(), bounds.tolist()
            shown, tokens, join = [self.id_text[i] for i in ids], [self.token_text[i] for i in ids], " ".join
            for word, a, b in zip(words, bounds, bounds[1:], strict=False):
                known[word] = join(shown[a:b]), join(tokens[a:b])
                self.remembered += 2 * len(word) + 6 * (b - a) + 100
        for run, parts in several:
            found = [known[p] for p in parts]
            known[run] = " ".join([f[0] for f in found]), " ".join([f[1] for f in found])
            self.remembered += len(run) + len(known[run][0]) + len(known[run][1]) + 100

    def runs(self, text: str) -> list[str]:
        """Parts of a text that the pattern never joins: its runs without white space, normalised."""
        if text.isascii():
            text = text.lower()
        else:
            text = unicodedata.normalize("NFC", text)
            # character by character: a final capital sigma stays the ordinary small one
            text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        # these four separate lines for Python and are symbols for the pattern
        return self.cut(text) if SEPARATORS.search(text) else text.split()

    def pieces(self, text: str) -> list[str]:
        """Runs of a text; a special token is a piece of its own, marked by a leading blank, which no run begins with."""
        if self.special_pattern is None or not any(mark in text for mark in self.special_marks):
            return self.runs(text)
        out, at = [], 0
        for m in self.special_pattern.finditer(text):
            out += self.runs(text[at : m.start()])
            out.append(" " + m.group())
            at = m.end()
        return out + self.runs(text[at:])

    def encode_text(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """For each text its ids and its decoded tokens, either joined by one space."""
        cut = [self.pieces(t) for t in texts]
        if self.remembered > REMEMBERED_CHARS:
            self.known, self.remembered = dict(self.special_runs), 0
        known = self.known
        self.learn({r for runs in cut for r in runs})
        for runs in cut:
            found = [known[r] for r in runs]
            yield " ".join([f[0] for f in found]), " ".join([f[1] for f in found])

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in next(self.encode_text([text]))[0].split()]

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids joined by one space; ids that the vocabulary lacks are left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


@functools.lru_cache(2)
def bpe_of(spec: str) -> WordBpe:
    """One encoder a worker process, so that its tasks share what it remembers."""
    return WordBpe(spec)


def encode_documents(docs: DataFrame, tokenizer_path: str, keep_ids: bool = False) -> DataFrame:
    """Encode and decode the whole ``text`` of every row.

    Returns doc_id, n_tokens, ids_sha256 (of the decimal ids joined by a space), decoded_sha256 (of the decoded text)
    and, with ``keep_ids``, the ids as one binary array of little-endian unsigned 32-bit numbers. A null text counts
    as empty and has no tokens; a null doc_id stays null; repeated rows are encoded each; other columns are ignored.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(spec.value)
        for batch in batches:
            for part in pieces(batch):
                rows = [t or "" for t in part.column(1).to_pylist()]
                counts, of_ids, of_text, ids = [], [], [], []
                for joined, decoded in bpe.encode_text(rows):
                    counts.append(joined.count(" ") + 1 if joined else 0)
                    of_ids.append(hashlib.sha256(joined.encode()).hexdigest())
                    of_text.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if keep_ids:
                        ids.append((np.fromstring(joined, np.uint32, sep=" ") if joined else np.zeros(0, np.uint32)).tobytes())
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns.append(pa.array(ids, pa.binary())), names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
