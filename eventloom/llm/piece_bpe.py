"""Encoding and decoding with a sentencepiece BPE model by a prefix table (operator 12).

Merging is never run over a text. Every prefix of a text has exactly one last token; an automaton over all pieces names
the pieces that end at each place, and of them that one is last which the last token of the prefix before it goes with:
the two are what merging makes of both together. The table of last tokens is filled from left to right, and the ids are
read off it from the end.

As no piece goes on past a word's end, texts are cut before each space that follows another character and, where the pieces
allow it, between Latin letters and what is none; a cut is looked up once for as long as a worker remembers it.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.jobs import pieces

SPACE = "▁"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: What stands for an unknown token in decoded text.
UNKNOWN_TEXT = " ⁇ "
#: Last token of the empty prefix, and of a prefix that ends in a character of no piece.
START, OTHER = -1, -2
#: Score of what is no piece.
NEVER = float("-inf")
#: Bytes of cuts with their ids and texts, and pairs of tokens, that a worker keeps at hand; beyond it the memory is emptied.
REMEMBERED_BYTES = 160_000_000
REMEMBERED_PAIRS = 500_000
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"

codecs.register_error("eventloom.each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and content of each field of a message in the protocol buffer format."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = number() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
        yield key >> 3, data[at : at + size]
        at += size


class PieceBpe:
    """Encoder and decoder of one BPE model file that neither rewrites text nor joins spaces, and falls back to bytes."""

    def __init__(self, model: bytes):
        self.piece: list[str] = []
        self.kind: list[int] = []
        score: list[float] = []
        normaliser: dict = {}
        for name, content in fields(model):
            if name == 1:
                of = dict(fields(content))
                self.piece.append(of[1].decode())
                score.append(struct.unpack("<f", of[2])[0] if 2 in of else 0.0)
                self.kind.append(of.get(3, NORMAL))
            elif name == 3:
                normaliser = dict(fields(content))
        if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(3, 1) or not normaliser.get(5, 1) or {USER, UNUSED} & set(self.kind):
            raise ValueError("only models that leave text as it is, add a space before it and have plain pieces alone")
        self.id_of = {p: i for i, p in enumerate(self.piece) if self.kind[i] == NORMAL}
        self.score = {p: score[i] for p, i in self.id_of.items()}
        self.byte_id = [0] * 256
        for i, p in enumerate(self.piece):
            if self.kind[i] == BYTE:
                self.byte_id[int(p[3:5], 16)] = i
        if BYTE not in self.kind:
            raise ValueError("the model has no byte pieces")
        self.byte_of = {i: b for b, i in enumerate(self.byte_id)}
        #: characters of some piece; all others are unknown and never part of a merge
        self.chars = {c for p in self.id_of for c in p}
        if not self.chars <= set(self.id_of):
            raise ValueError("a character of a piece is no piece")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            if len(p) == 1 or self.merged(p) == [p]:  # merging never makes the others
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        latin = re.compile(f"[{LATIN}]")
        beside = {(a == SPACE, bool(latin.match(a)), b == SPACE, bool(latin.match(b))) for p in self.id_of for a, b in zip(p, p[1:], strict=False)}
        if any(b and not a for a, _, b, _ in beside):
            self.cuts = re.compile("(?s:.+)")
        elif any(x != y and not a for a, x, _, y in beside):
            self.cuts = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        else:
            self.cuts = re.compile(f"{SPACE}*[{LATIN}]+|{SPACE}*[^{LATIN}{SPACE}]+|{SPACE}+")
        self.length = [len(p) for p in self.piece]
        special = {UNKNOWN: UNKNOWN_TEXT, CONTROL: ""}
        #: text of each piece; none for bytes
        self.text = [None if k == BYTE else special.get(k, p.replace(SPACE, " ")) for p, k in zip(self.piece, self.kind, strict=True)]
        self.id_text = [str(i) for i in range(len(self.piece))]
        self.together: dict[int, bool] = {}
        self.known: dict[str, tuple[str, str]] = {}
        self.remembered = 0

    def merged(self, text: str) -> list[str]:
        """What merging makes of a short text: the pair of the best score first, of equals the leftmost."""
        of, parts = self.score.get, list(text)
        scores = [of(x + y, NEVER) for x, y in zip(parts, parts[1:], strict=False)]
        while scores:
            best = max(scores)
            if best == NEVER:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = of(parts[at - 1] + parts[at], NEVER)
            if at < len(scores):
                scores[at] = of(parts[at] + parts[at + 1], NEVER)
        return parts

    def goes_with(self, before: int, token: int) -> bool:
        """Whether two tokens stand side by side: merging makes both, and neither more nor less, of their text."""
        a, b = self.piece[before], self.piece[token]
        return self.merged(a + b) == [a, b]

    def tokens(self, unit: str) -> list[int]:
        """Ids of a text whose spaces are marked, through the table of each prefix's last token."""
        size, together = len(self.piece), self.together
        last = [OTHER] * (len(unit) + 1)
        last[0] = START
        for at, (token, length) in self.automaton.iter(unit):
            end = at + 1
            if last[end] != OTHER:
                continue
            before = last[end - length]
            if before >= 0:
                pair = before * size + token
                fits = together.get(pair)
                if fits is None:
                    fits = together[pair] = self.goes_with(before, token)
                if not fits:
                    continue
            last[end] = token
        ids, at = [], len(unit)
        while at:
            token = last[at]
            if token == OTHER:
                char = unit[at - 1]
                if char in self.chars:
                    raise ValueError(f"no token ends a prefix of {unit[:at]!r}")
                ids += [self.byte_id[b] for b in reversed(char.encode())]
                at -= 1
            else:
                ids.append(token)
                at -= self.length[token]
        ids.reverse()
        if len(together) > REMEMBERED_PAIRS:
            together.clear()
        return ids

    def spelled(self, ids: list[int]) -> str:
        """The text of ids, the space before the first one included; bytes that are no text become U+FFFD each."""
        texts = [self.text[i] for i in ids]
        if None not in texts:
            return "".join(texts)
        out, raw = [], bytearray()
        for i, text in zip(ids, texts, strict=True):
            if text is None:
                raw.append(self.byte_of[i])
                continue
            out += [raw.decode("utf-8", "eventloom.each_byte"), text]
            raw = bytearray()
        return "".join(out) + raw.decode("utf-8", "eventloom.each_byte")

    def units(self, text: str) -> list[str]:
        """A text with its first space and marked spaces, cut where no piece goes across."""
        return self.cuts.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for unit in self.units(text) for i in self.tokens(unit)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the space that encoding puts first. Control pieces have no text."""
        first = next((i for i in ids if self.kind[i] != CONTROL), None)
        text = self.spelled(ids)
        return text[1:] if first is not None and self.piece[first].startswith(SPACE) else text

    def encode_text(self, text: str) -> tuple[str, str]:
        """Decimal ids joined by commas, and the decoded text."""
        known, units = self.known, self.units(text)
        if self.remembered > REMEMBERED_BYTES:
            known.clear()
            self.remembered = 0
        for unit in set(units).difference(known):
            ids = self.tokens(unit)
            known[unit] = found = ",".join([self.id_text[i] for i in ids]), self.spelled(ids)
            self.remembered += 2 * (len(unit) + len(found[1])) + len(found[0]) + 350
        found = [known[unit] for unit in units]
        return ",".join([f[0] for f in found]), "".join([f[1] for f in found])[1:]


@functools.lru_cache(2)
def piece_bpe_of(model: bytes) -> PieceBpe:
    """One encoder a worker process, so that its tasks share what it remembers."""
    return PieceBpe(model)


def encode_documents(docs: DataFrame, model_path: str, keep_ids: bool = False) -> DataFrame:
    """Encode and decode the whole ``text`` of every row.

    Returns doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the decoded text) and,
    with ``keep_ids``, the ids as an array. A null text counts as empty and has no tokens; a null doc_id stays null;
    repeated rows are encoded each; other columns are ignored. Characters of no piece become their bytes.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe_of(model.value)
        for batch in batches:
            for part in pieces(batch):
                counts, of_ids, of_text, ids = [], [], [], []
                for text in part.column(1).to_pylist():
                    joined, decoded = bpe.encode_text(text or "")
                    counts.append(joined.count(",") + 1 if joined else 0)
                    of_ids.append(hashlib.sha256(joined.encode()).hexdigest())
                    of_text.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if keep_ids:
                        ids.append(np.fromstring(joined, np.int32, sep=",") if joined else np.zeros(0, np.int32))
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32()))), names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
