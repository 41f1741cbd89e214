"""Operators 11 to 13 against the libraries and against plain versions: alignment of tokenizers, pieces, periodic runs."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import public_tokenizers
from eventloom.llm import alignment, periods, piece_bpe, queries

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LONG = "ipsum dolor, sit amet. " * 20_000
ROWS = [(1, "Hello wörld, don't\n\nstop 日本 😀"), (2, None), (None, ""), (1, "Hello wörld, don't\n\nstop 日本 😀"), (3, LONG), (4, " <|endoftext|> </s><0x41>"), (5, "a▁b"), (6, "x" * 5000), (7, " \n ")]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def ours():
    with open(PIECES, "rb") as f:
        return piece_bpe.PieceBpe(f.read())


@pytest.fixture(scope="module")
def theirs():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def same(ours, theirs, text):
    expected = theirs.encode(text)
    assert ours.encode(text) == expected
    assert ours.encode_text(text) == (",".join(map(str, expected)), theirs.decode(expected))
    assert ours.decode(expected) == theirs.decode(expected)


@pytest.mark.parametrize("text", ["", " ", "a▁b", "\x00", "▁▁ a", "<s></s><unk><0x41>", "é́ș", "नि 日本", "😀👍🏽", ");\r\n", "a" * 3000, "İ ſ"])
def test_piece_cases(ours, theirs, text):
    same(ours, theirs, text)


def test_runs_of_spaces(ours, theirs):
    for n in range(70):
        for text in (" " * n, "a" + " " * n + "b", " " * n + "the"):
            same(ours, theirs, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abtheinrs  \n\t\x00.,01é日本😀▁<>xſ가́�;)\r", max_size=40))
def test_pieces_equal_the_library(ours, theirs, text):
    same(ours, theirs, text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 260)), max_size=10))
def test_decoding_any_ids_equals_the_library(ours, theirs, ids):
    assert ours.decode(ids) == theirs.decode(ids)


def test_piece_documents(spark, theirs, monkeypatch):
    monkeypatch.setattr(piece_bpe, "REMEMBERED_BYTES", 0)
    df = spark.createDataFrame([(*r, 0) for r in ROWS], "doc_id int, text string, ids_sha256 int")
    got = piece_bpe.encode_documents(df, PIECES, keep_ids=True).collect()
    for (doc_id, text), r in zip(ROWS, got, strict=True):
        ids = theirs.encode(text or "")
        assert (r.doc_id, r.n_tokens, r.ids) == (doc_id, len(ids), ids)
        assert (r.ids_sha256, r.decoded_sha256) == (sha(",".join(map(str, ids))), sha(theirs.decode(ids)))
    assert piece_bpe.encode_documents(df.limit(0), PIECES).count() == 0


# --- alignment


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_galloping_finds_common_ends(a, b):
    a, b = sorted(a), sorted(b)
    assert alignment.common_ends(a, b) == [(a.index(x), b.index(x)) for x in sorted({*a} & {*b})]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 30)), st.sets(st.integers(1, 30)))
def test_overlap_ranges(a, b):
    a, b = sorted({*a, 31}), sorted({*b, 31})
    begins = [0, *b]
    for (first, last), start, end in zip(alignment.overlap_ranges(a, b), [0, *a], a, strict=False):
        assert list(range(first, last)) == [k for k in range(len(b)) if max(start, begins[k]) < min(end, b[k])]


@pytest.fixture(scope="module")
def libraries(theirs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    back = {s: i for i, s in enumerate(alignment.byte_symbols())}

    def tokens(text):
        """[(A id, bytes)], [(B id, bytes)] of a text; None where bytes are lost."""
        if not text:
            return None
        a = [(i, bytes(back[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(theirs.id_to_piece(i)[3:5], 16)]) if theirs.is_byte(i) else theirs.id_to_piece(i).replace("▁", " ").encode()) for i in theirs.encode(text)]
        raw = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else None

    return tokens


def slow_alignment(tokens, rows):
    """What the operator returns, by sets of ends over whole texts and a count over all rows."""
    out, counts = [], Counter()
    for doc_id, text in rows:
        found, groups, links = tokens(text), [], []
        if found:
            ends = []
            for side in found:
                at, here = 0, {}
                for k, (_, raw) in enumerate(side):
                    at += len(raw)
                    here[at] = k
                ends.append(here)
            i = j = 0
            for end in sorted(ends[0].keys() & ends[1].keys()):
                a, b = ends[0][end], ends[1][end]
                groups.append(",".join(str(x) for x, _ in found[0][i : a + 1]) + "|" + ",".join(str(x) for x, _ in found[1][j : b + 1]))
                links.append((found[0][a][0], found[1][b][0]))
                i, j = a + 1, b + 1
        counts.update(links)
        out.append((doc_id, len(found[0]) if found else 0, len(found[1]) if found else 0, groups, links))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (d, a, b, len(g), len(li), sum(counts[x] == best[x[1]] for x in li), sum(counts[x] for x in li), sha(";".join(g)) if g else "") for d, a, b, g, li in out
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def mixed(n=60):
    rng = random.Random(4)
    parts = [*"abthes 's'tll  \n\n\t\r01é日😀ſΩя.,!?-_▁́ \u0085\x1c\x00ñ²ªǅ", " the", " and", " don't", "<|endoftext|>", ". ", ".\n", ");\r\n", "नि"]
    return [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(40)))) for i in range(n)]


def test_aligned_documents(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED_BYTES", 0)
    rows = ROWS + mixed(400)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id int, text string, pairs int")
    got = alignment.align_documents(df, BYTES, PIECES, keep_groups=True).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == slow_alignment(libraries, rows)
    assert all(sha(r.groups) == r.groups_sha256 if r.groups else r.groups_sha256 == "" for r in got)
    for r, (_, text) in zip(got, rows, strict=True):
        if r.n_a and len(text) < 100:
            sides = [[sum(len(x) for _, x in side[: k + 1]) for k in range(len(side))] for side in libraries(text)]
            assert r.n_overlaps == sum(last - first for first, last in alignment.overlap_ranges(*sides))
    assert alignment.align_documents(df.limit(0), BYTES, PIECES).collect() == []


# --- periodic runs


def slow_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            start, length = at, end - at + q
            if end > at and length >= max(6, 4 * q) and not any(words[start : start + length - r] == words[start + r : start + length] for r in range(1, q)):
                out.append((start, length, q))
            at = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rng):
    words = []
    for _ in range(rng.randrange(1, 6)):
        part = [rng.choice("abcdefghij"[: rng.choice([1, 2, 3, 10])]) for _ in range(rng.randrange(1, rng.choice([3, 12, 40])))]
        words += (part * rng.randrange(1, 9))[: rng.randrange(1, 200)]
    return words


def test_runs_equal_the_plain_search():
    rng = random.Random(2)
    for _ in range(300):
        texts = [repetitive(rng) if rng.random() < 0.9 else [] for _ in range(rng.randrange(1, 4))]
        numbers = {}
        got = periods.runs_of([periods.numbered([w.encode() for w in t], numbers) for t in texts])
        assert got == [slow_runs(t) for t in texts]


def slow_row(doc_id, text, reorder):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if reorder and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    return doc_id, len(runs), *best, milli, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped))


def test_run_documents(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, rng.choice(" \n\t").join(repetitive(rng))) for i in range(150)] + [(None, "a " * 9), (None, None), (7, "a a a"), (7, "x y " * 30_000), (8, ""), (8, "Z" * 9000)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id int, text string, start int")
    for reorder in (None, periods.repeated_tail):
        got = periods.periodic_runs(df, reorder, keep_runs=True).collect()
        for r, (doc_id, text) in zip(got, rows, strict=True):
            if len(text or "") < 5000:
                assert tuple(r)[:8] == slow_row(doc_id, text, reorder)
            assert sha(r.collapsed) == r.collapsed_sha256 and len(r.collapsed.split()) == r.n_kept or " " in text
    long = next(r for r in periods.periodic_runs(df).collect() if r.n_words == 60_000)
    assert (long.n_runs, long.start, long.length, long.period, long.n_kept) == (1, 0, 60_000, 2, 2)
    assert periods.periodic_runs(df.limit(0)).collect() == []


def test_queries_take_whole_tables(spark, tmp_path, libraries, theirs):
    rows = mixed(80) + [(1000 + i, " ".join(repetitive(random.Random(i)))) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string")).write.parquet(f"{tmp_path}/documents.parquet")
    known = queries.queries()
    got = known["op13_periodic_runs"](spark, str(tmp_path)).drop("n_words", "n_kept").collect()
    assert {r.doc_id: tuple(r) for r in got} == {r[0]: slow_row(*r, True) for r in rows}
    got = known["op11_alignment"](spark, str(tmp_path)).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(slow_alignment(libraries, rows))
    got = known["op12_piece_bpe"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.ids_sha256) for r in got} == {(i, sha(",".join(map(str, theirs.encode(t))))) for i, t in rows}
