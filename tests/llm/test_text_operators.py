"""Single-text operators: BPE, languages, quality, personal data, licences, html."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import public_tokenizers
from eventloom.llm import bpe, html_text, langid, licences, personal_data, quality
from eventloom.llm.arrays import range_hashes, slices, words

PATH = public_tokenizers.path("word_bpe_49k.json")
LONG = "lorem ipsum dolor " * 20_000


@pytest.fixture(scope="module")
def ours():
    with open(PATH, encoding="utf-8") as f:
        return bpe.WordBpe(f.read())


@pytest.fixture(scope="module")
def theirs():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.no_truncation(), t.no_padding()
    return t


def same(ours, theirs, text):
    expected = theirs.encode(text, add_special_tokens=False).ids
    ids, decoded = next(ours.encode_text([text]))
    assert ids == " ".join(map(str, expected))
    assert decoded == theirs.decode(expected, skip_special_tokens=False)
    assert ours.decode(expected) == decoded and ours.encode(text) == expected


@pytest.mark.parametrize("text", ["", " \n", "a\u0085b c\x1cd", "ΣΑΣ ΟΔΟΣ", "İstanbul ẞ ǅ", "a" * 3000 + "!" * 3001, "it's they'LL I'D", "<|endoftext|>x <|startoftext|>", "é ﬁ Ⅷ ½", "日本語 😀👍🏽"])
def test_bpe_cases(ours, theirs, text):
    same(ours, theirs, text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abAB'stredmlv \n\t!?.,0123éÉßΣσ<|>endoftx_́\u0085\x1e日😀²", max_size=40))
def test_bpe_equals_the_library(ours, theirs, text):
    same(ours, theirs, text)


def test_bpe_documents(spark, theirs):
    df = spark.createDataFrame([(1, "Hello wörld", 0), (2, None, 0), (None, "", 0), (1, "Hello wörld", 0), (3, LONG, 0)], "doc_id int, text string, n_tokens int")
    got = bpe.encode_documents(df, PATH, keep_ids=True).collect()
    assert [r.n_tokens for r in got] == [len(theirs.encode(t or "", add_special_tokens=False).ids) for t in ("Hello wörld", None, "", "Hello wörld", LONG)]
    assert got[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert np.frombuffer(got[0].ids, np.uint32).tolist() == theirs.encode("Hello wörld", add_special_tokens=False).ids
    assert bpe.encode_documents(df.limit(0), PATH).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\té\x1c", max_size=12), min_size=1, max_size=6))
def test_words_are_those_of_the_pattern(texts):
    (part,) = slices(pa.array(texts, pa.string()))
    found = words(part)
    for i, text in enumerate(texts):
        expected = re.findall(r"[^\x20\x09-\x0D]+", text)
        got = [part.data[a:b].tobytes().decode() for a, b in zip(found.starts[found.bounds[i] : found.bounds[i + 1]], found.ends[found.bounds[i] : found.bounds[i + 1]], strict=True)]
        assert got == expected


def test_equal_contents_have_equal_hashes_anywhere():
    codes = np.arange(50, dtype=np.uint64) % np.uint64(10)
    h = range_hashes(codes, np.array([0, 10, 20, 1]), np.array([7, 17, 27, 8]))
    assert h[0] == h[1] == h[2] != h[3]


VOICES = {"en": "the and of this with from", "de": "der die und nicht mit auf", "fr": "les des une pour dans que", "es": "los las una para con por"}


def spoken(n=240):
    rng = random.Random(1)
    langs = sorted(VOICES)
    return [(i, " ".join(rng.choice(VOICES[langs[i % 4]].split()) for _ in range(30)), langs[i % 4]) for i in range(n)]


def test_languages(spark):
    extra = [(1000, None, "en"), (1001, "", None), (1002, "123 !?", "en"), (1003, "É", None), (None, "the and of this with", None), (1004, "der die das und nicht " * 20_000, None)]
    df = spark.createDataFrame(spoken() + extra, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(got) == 246
    held = [i for i, _, _ in spoken() if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out for i in held) and sum(r.held_out for r in got.values()) >= len(held)
    assert all(got[i].lang_pred == lang for i, _, lang in spoken())
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1000].score == 0 and not got[1000].accepted
    assert got[1003].lang_pred in VOICES and got[1004].lang_pred == "de" and got[None].lang_pred == "en" and not got[None].held_out
    assert all(0 <= r.score <= 1 for r in got.values())


def test_prediction_uses_the_text_alone(spark):
    df = spark.createDataFrame(spoken(), "doc_id long, text string, lang string")
    model = langid.fit(df, F.lit(True))
    a = langid.predict(df, model, ["doc_id", "text"]).collect()
    b = langid.predict(df.withColumn("lang", F.lit("xx")), model, ["doc_id", "text"]).collect()
    assert a == b


def test_no_labelled_rows(spark):
    df = spark.createDataFrame([(1, "words")], "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    assert langid.identify(df).first().lang_pred == "und"
    assert langid.identify(df.limit(0)).count() == 0


def graded(n=400):
    rng = random.Random(2)
    vocabulary = [f"wo{chr(97 + i % 26)}rd{chr(97 + i // 26)}" for i in range(200)]
    good = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(20, 200))) + "."
    bad = lambda: " | ".join(rng.choice(vocabulary).upper() + "!!" for _ in range(rng.randint(20, 200)))
    return [(i, good() if i % 4 else bad(), int(i % 4 > 0)) for i in range(n)]


def test_quality(spark):
    data = graded()
    docs = spark.createDataFrame([(i, t) for i, t, _ in data] + [(9001, None), (9002, ""), (None, "words here")], "doc_id long, text string").withColumn("score", F.lit(1))
    labels = spark.createDataFrame([(i, q) for i, _, q in data] + [(9001, 1), (5, 1), (None, 0), (7, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.assess(docs, labels).collect()}
    assert len(got) == 403
    held = [(got[i].score, q) for i, _, q in data if got[i].held_out]
    assert held and min(s for s, q in held if q) > max(s for s, q in held if not q)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())
    assert got[9001].score == got[9002].score


def test_factorisation_identity():
    rng = np.random.default_rng(1)
    model = quality.FactorisationMachine(0.1, rng.normal(size=(1 << quality.BUCKET_BITS, 1 + quality.RANK)), rng.normal(size=(len(quality.DENSE), 1 + quality.RANK)), np.zeros(len(quality.DENSE)), np.ones(len(quality.DENSE)))
    buckets, dense = np.array([3, 99, 3, 7]), rng.normal(size=(1, len(quality.DENSE)))
    x = np.concatenate([np.full(4, 0.25), dense[0]])
    rows = np.vstack([model.word[buckets], model.dense])
    slow = 0.1 + x @ rows[:, 0] + sum(x[i] * x[j] * (rows[i, 1:] @ rows[j, 1:]) for i in range(len(x)) for j in range(i))
    assert model.raw(buckets, np.array([0, 4]), dense)[0] == pytest.approx(slow)


PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def slow_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True, "card": 13 <= len(digits) <= 19 and personal_data.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.b@c-_%+019 25()4\n", max_size=60))
def test_base_spans(text):
    assert personal_data.base_spans(text) == slow_spans(text)


@pytest.mark.parametrize("text", ["1.1.1.1.1.1.1.1", "0001.2.3.255", "1.2.3.256", "4111 1111 1111 1111", "4111111111111112", "+1 (136) 555-7479", "+1 2", "a@b.c_d@e.f", "@@a@b", "x" * 50_000 + "@", "1" * 50_000])
def test_base_span_cases(text):
    assert personal_data.base_spans(text) == slow_spans(text)


def numbers():
    rng = random.Random(3)
    phone = lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    rows = []
    for i in range(300):
        number = phone()
        text = f"call {number} or mail u{i}@example.com from 10.0.{i % 250}.7 re 41111111111111{rng.randint(10, 99)} in {1990 + i % 30} thanks"
        rows.append((i, text + (f"\nagain {number} since {1990 + i % 30}\nor u{i}@example.com" if i % 3 == 0 else "")))
    return rows


def test_personal_data(spark):
    extra = [(1000, "ring +1 (415) 555-2671 today\nas I said\nuse (415) 555-2671 instead"), (1001, None), (1002, ""), (None, "a@b.cd"), (1003, "clean words only"), (1004, "x " * 100_000 + "a@b.cd")]
    df = spark.createDataFrame(numbers() + extra, "doc_id long, text string").withColumn("spans", F.lit(1))
    got = {r.doc_id: r for r in personal_data.find(df).collect()}
    for i, text in numbers() + extra:
        base = slow_spans(text or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(sum(k == kind for k, _, _ in base) for kind in personal_data.KINDS)
        assert set(f"{k}:{s}:{e}" for k, s, e in base) <= set(got[i].spans.split(","))
    assert got[1000].n_added == 1 and got[1000].spans.count("phone") == 2
    assert got[1003].spans == "" and got[1001].spans == "" and got[1004].spans == "email:200000:200006"
    hidden = {r.doc_id: r.text for r in personal_data.redact(df).collect()}
    assert hidden[1000] == "ring <PHONE> today\nas I said\nuse <PHONE> instead" and hidden[1001] is None and hidden[1003] == "clean words only"


def test_repetitions_agree_by_what_was_learned():
    texts = [t for _, t in numbers()]
    model = personal_data.SkipChain().fit(texts)
    phone, other, email = (personal_data.LABELS.index(k) for k in ("phone", "other", "email"))
    assert model.skip[phone, phone] > 0.5 > model.skip[phone, other] and model.skip[email, email] > 0.5 and model.skip[other, other] > 0.5
    assert np.allclose(model.skip, model.skip.T)
    text = "ring +1 (415) 555-2671 today\nas I said\nuse (415) 555-2671 instead"
    without = personal_data.SkipChain().fit(texts)
    without.skip[:] = 0  # a plain chain
    base = personal_data.base_spans(text)
    sure = lambda m: m.marginals(personal_data.Sites(text))[-2:, phone]
    assert len(model.more_spans(text, base)) == 1 and (sure(model) > sure(without)).all()
    # a bare number that no one repeats is not made surer
    alone = personal_data.Sites("use (415) 555-2671 instead")
    assert np.allclose(model.marginals(alone), without.marginals(alone))


def test_message_passing_is_exact_on_a_chain():
    model = personal_data.SkipChain()
    rng = np.random.default_rng(5)
    model.unary, model.chain = rng.normal(size=model.unary.shape), rng.normal(size=model.chain.shape)
    sites = personal_data.Sites("+1 (136) 555-7479 a@b.cd")
    sites.skip = []
    n, k = len(sites.spans), len(personal_data.LABELS)
    unary = np.stack([model.unary[f].sum(0) for f in sites.features()])
    total = np.zeros((n, k))
    for labels in np.ndindex(*[k] * n):
        weight = np.exp(sum(unary[i, a] for i, a in enumerate(labels)) + sum(model.chain[labels[a], labels[b]] for a, b in sites.chain))
        for i, a in enumerate(labels):
            total[i, a] += weight
    assert np.allclose(model.marginals(sites), total / total.sum(1, keepdims=True), atol=1e-2)


def test_licences(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    data = [
        (1, "Text.\nReleased under the MIT License.\nMore"), (2, f"MIT License\n\n{mit}"), (3, "LICENSED!! UNDER!! THE!! APACHE!! LICENSE,!! VERSION!! 2.0."), (4, "We talked about a licence."), (5, None), (6, ""),
        (7, "First. Licensed under CC BY-NC 4.0. Then this work is licensed under the\nGNU General Public License, version 3. End"), (None, "SPDX-License-Identifier: Apache-2.0"), (8, "words here " * 100_000 + "\nLicensed under CC BY-NC 4.0."),
    ]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(data, "doc_id long, text string").withColumn("matches", F.lit(1))).collect()}
    assert [got[i].licences for i in (1, 2, 3, 4, 5, 6, 7, None, 8)] == ["MIT", "MIT", "Apache-2.0", "", "", "", "CC-BY-NC-4.0", "Apache-2.0", "CC-BY-NC-4.0"]
    assert got[2].matches[0].rule == "mit/title+mit/grant+mit/notice" and len(got[2].matches) == 1
    assert data[0][1][got[1].matches[0].start : got[1].matches[0].end] == "Released under the MIT License."


@pytest.fixture(scope="module")
def rules():
    return licences.Rules()


def test_every_identifier_is_in_a_rule_and_every_sentence_is_found(rules):
    used = {name for rule, _ in rules.rules for name in rule}
    assert set(licences.SENTENCES) <= used and set(rules.names.values()) <= used and set(rules.spdx.values()) <= used
    alone = {rule[0] for rule, _ in rules.rules if len(rule) == 1}
    for sentence, name in rules.ids.items():
        found = rules.match(sentence)
        assert [f[0] for f in rules.sentences(sentence)] == [name]
        assert bool(found) == (name in alone), sentence
        assert name in alone or name in licences.CONTEXT or len({r for r, _ in rules.rules if name in r}) > 0
    of = {rule[0]: licence for rule, licence in rules.rules if len(rule) == 1}
    for name, found in rules.names.items():
        for text in (f"Licensed under the {name}.", f"Words before.\nThis project is released under {name} (see LICENSE).\nWords after"):
            assert [m[0] for m in rules.match(text)] == [of[found]], text
    assert len(rules.ids) + len(rules.names) > 500


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Released under CC0 1.0", ["CC0-1.0"]), ("MIT OR Apache-2.0", ["MIT", "Apache-2.0"]), ("Licensed under the MIT License (see LICENSE)", ["MIT"]), ("// SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR MIT", ["GPL-2.0", "MIT"]),
        ("license = \"BSD-3-Clause AND (ISC OR Zlib)\"", ["BSD-3-Clause", "ISC", "Zlib"]), ("Licensed under the BSD License.", ["BSD"]), ("License: MIT", ["MIT"]), ("Dual licensed under the MIT License and the Apache License, Version 2.0.", ["MIT", "Apache-2.0"]),
        ("You AND me OR them", []), ("MIT OR NotALicence-1.0", []), ("the license: a story", []), ("He was released under the moon", []), ("licensed under", []), ("OR OR OR", []), ("license:", []),
        ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by\nthe Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", ["LGPL-2.1"]),
    ],
)
def test_licence_statements(rules, text, expected):
    assert [m[0] for m in rules.match(text)] == expected
    assert [m[0] for m in rules.match(f"A line.\n{text}\nAnother line.")] == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("It is licensed under the MIT licence, see the file.", ["MIT"]), ("This code is public domain.", ["Public-Domain"]), ("The software has been placed in the public domain", ["Public-Domain"]),
        ("SPDX-License-Identifier: LicenseRef-x AND MIT", ["MIT"]), ("License: Foo-1.0 OR (ISC AND Bar)", ["ISC"]), ("License: a story of MIT", []), ("Our tool, which you can get here, is released under the Apache License, Version 2.0 and needs Java.", ["Apache-2.0"]),
        ("The parts are licensed under the MIT License, the rest is available under the terms of the Mozilla Public License 2.0, as we said.", ["MIT", "MPL-2.0"]), ("The model is not licensed under the MIT License.", []), ("He was released under MIT supervision", []),
        ("The package is published under MIT as of today", ["MIT"]), ("Macros, released under the LaTeX Project Public License, are old.", ["LPPL-1.3c"]), ("Goods are provided under the bridge by the GPL crowd", []),
    ],
)
def test_statements_within_sentences(rules, text, expected):
    assert [m[0] for m in rules.match(text)] == expected
    assert [m[0] for m in rules.match(f"A line.\n{text}\nAnother line.")] == expected


def test_reserved_rights_are_found_and_part_no_rule(rules):
    assert rules.match("Story.\nAll rights reserved.") == [("Proprietary", "proprietary/reserved", 7, 27)]
    grant, notice = licences.SENTENCES["mit/grant"][0], licences.SENTENCES["mit/notice"][0]
    assert [m[:2] for m in rules.match(f"MIT License\nAll rights reserved.\n{grant}\nAll rights reserved.\n{notice}.")] == [("MIT", "mit/title+mit/grant+mit/notice")]
    assert [m[0] for m in rules.match("Released under the MIT License.\nText.\nAll rights reserved.")] == ["MIT", "Proprietary"]
    redistribution, endorsement = licences.SENTENCES["bsd/redistribution"][0], licences.SENTENCES["bsd/no-endorsement"][0]
    assert [m[0] for m in rules.match(f"{redistribution}\nAll rights reserved.\n{endorsement}.")] == ["BSD-3-Clause"]
    assert len(rules.match("All rights reserved.\n" * 20_000)) == 20_000


def test_the_filter_changes_nothing(rules):
    import copy

    everything = copy.copy(rules)
    everything.trigger = [""]
    rng = random.Random(3)
    known = [*rules.ids, *(f"licensed under {n}" for n in rules.names)]
    for _ in range(300):
        text = "\n".join(rng.choice([rng.choice(known), " ".join(rng.choice("a story of the sea and old ships under way".split()) for _ in range(9))]) for _ in range(rng.randint(0, 6)))
        assert rules.match(text) == everything.match(text)


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


def test_html(spark):
    chrome = "<nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='ad'>Buy</div>"
    article = "<article><h1>Title &amp; more</h1><p>One <b>two</b>\n three.<p><b>Four<br><p>five</p><script>var t='</p>';</script><div class='comments'><p>first!</p></div></article>"
    data = [
        (1, "http://h.example/a", page(chrome + article + "<footer>&copy; h</footer>")),
        (2, "http://h.example/b", None), (3, None, ""), (4, "http://x.example/", "just &lt;text&gt; <p>and  more"), (5, "http://h.example/c", page("<main><p>Main</p></main><aside>no</aside><form>no</form>")),
        (None, "u", page("<p>a<!-- no --></p>")), (6, "http://y.example", page("<p hidden>x</p><p>é&#233;&nbsp;z</p>")), (7, "http://z.example", "<p " + 'a="' * 3000), (8, "http://z.example", page("<p>" + "w " * 100_000 + "</p>")),
    ]
    got = {r.page_id: r for r in html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()}
    assert got[1].text == "Title & more\n\nOne two three.\n\nFour\n\nfive" and got[1].n_chars == len(got[1].text)
    assert [got[i].text for i in (2, 3, 4, 5, None, 6)] == ["", "", "just <text>\n\nand more", "Main", "a", "éé z"]
    assert got[8].n_chars == 199_999


@pytest.mark.parametrize("sent", [1000, 0])
def test_templates_go_where_they_recur(spark, sent):
    banner = "<div><div>Welcome to our site</div></div>"
    data = [(i, f"http://{'h' if i % 2 else 'g'}.example/{i}", page((banner if i % 2 else "") + f"<div>Story number {i}</div>")) for i in range(40)]
    data += [(100, "http://g.example/x", page(banner + "<div>Last</div>"))]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string"), max_sent=sent).collect()}
    assert all(got[i] == f"Story number {i}" for i in range(40))
    assert got[100] == "Welcome to our site\n\nLast"


@pytest.mark.parametrize("sent", [1000, 0])
def test_copies_of_a_page_make_no_templates(spark, sent):
    banner, listed = "<div>Welcome</div>", "<article><p>Steps</p><ul><li>one</li><li>two</li></ul><div><p>End</p></div></article>"
    bodies = [banner + "<div>Plain story</div>"] * 6 + [banner + listed] * 6 + [f"{banner}<div>Story {i}</div>" for i in range(4)]
    data = [(i, f"http://h.example/{i}", page(b)) for i, b in enumerate(bodies)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string"), max_sent=sent).collect()}
    assert [got[i] for i in range(16)] == ["Plain story"] * 6 + ["Steps\n\none\n\ntwo\n\nEnd"] * 6 + [f"Story {i}" for i in range(4)]
    # nor do copies make a template of the host rare: it is on 6 of 7 different pages
    data += [(i, f"http://h.example/{i}", page("<p>Other</p>")) for i in range(100, 200)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string"), max_sent=sent).collect()}
    assert got[12] == "Story 0" and got[0] == "Plain story"


@pytest.mark.parametrize("sent", [1000, 0])
def test_articles_survive_their_copies(spark, sent):
    body = "<div><section>" + "".join(f"<p>Sentence {i} of the long story about a river.</p>" for i in range(20)) + "</section></div>"
    other = "<div>" + "".join(f"<p>Part {i} of another long story about hills and the sea.</p>" for i in range(20)) + "</div>"
    share, banner = "<div>Tell your friends</div>", "<div>Welcome to the site</div>"
    pages = [(1, "http://h.example/a", page(banner + f"<article><h1>Head</h1>{body}</article>"))] * 6  # rows that repeat
    pages += [(10 + i, f"http://h.example/{i}", page(banner + f"<div>Advert {i}</div><article><h1>Head</h1>{body}</article>")) for i in range(6)]
    pages += [(20 + i, f"http://h.example/n{i}", page(banner + f"<article><h1>Head {i}</h1>{body}{share}</article>")) for i in range(6)]  # near copies
    pages += [(30 + i, f"http://h.example/m{i}", page(banner + f"<div>Number {i}</div>{other}")) for i in range(6)]  # near copies without an article
    pages += [(None if i % 2 else 40 + i, f"http://h.example/s{i}", page(banner + f"<article><p>{'Different words ' * 9}{i}.</p>{share}</article>")) for i in range(8)]
    got = [(r.page_id, r.text) for r in html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string"), max_sent=sent).collect()]
    story = "\n\n".join(f"Sentence {i} of the long story about a river." for i in range(20))
    assert len(got) == len(pages)
    for page_id, text in got:
        if page_id in range(1, 20):
            assert text == f"Head\n\n{story}"
        elif page_id in range(20, 30):
            assert text == f"Head {page_id - 20}\n\n{story}"
        elif page_id in range(30, 40):
            assert text == f"Number {page_id - 30}\n\n" + "\n\n".join(f"Part {i} of another long story about hills and the sea." for i in range(20))
        else:
            assert text.startswith("Different words") and text.endswith(".")


def test_templates_equal_a_plain_count(spark):
    rng = random.Random(4)
    widgets = [f"<div>Widget {i} says hello</div>" for i in range(12)]
    pages = []
    for i in range(120):
        own = [w for j, w in enumerate(widgets) if rng.random() < j / 24]
        pages.append((i, f"http://h{i % 3}.example/{i}", page("".join(own) + f"<article><p>{'Story words ' * 30}{i}</p></article><section>Note {i}</section>" if i % 2 else "".join(own) + f"<p>Text of page {i}</p>"), own))
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")).collect()}
    for i, url, _, own in pages:
        hosts = [p for p in pages if p[1].split("/")[2] == url.split("/")[2]]
        gone = {w for w in widgets if (n := sum(w in p[3] for p in hosts)) >= 5 and n >= 0.1 * len(hosts)}
        left = [w[5:-6] for w in own if w not in gone]
        assert got[i] == ("Story words " * 30 + str(i) if i % 2 else "\n\n".join([*left, f"Text of page {i}"]))


def test_only_whole_class_words_mark_boilerplate():
    keep = ["search-results", "related-work", "social-science", "share-price", "ad-hoc", "sponsor-story", "reply-all-fiasco", "footnote", "commentary", "download", "notice-period"]
    drop = ["ad", "big ad", "cookie-banner", "comments", "comment-list", "site_sidebar box" , "sidebar-widget", "share-buttons", "newsletter-form", "reader-comments comments"]
    for name in keep:
        assert html_text.Page(f"<article><p>a</p><div class='{name}'><p>b</p></div></article>").text(lambda h: False) == "a\n\nb", name
    for name in drop:
        assert html_text.Page(f"<article><p>a</p><div class='{name}'><p>b</p></div></article>").text(lambda h: False) == "a", name
    assert html_text.Page("<article><pre><code><span class='comment'>x</span> = 1</code></pre></article>").text(lambda h: False) == "x = 1"


@pytest.mark.parametrize("unit", ['<p "', "<a b='", "<a", "<!", '<p ">" ', "<p '\">", "&#9", "&", "<", "</", "<!--", "<![CDATA[", "<p><button><div>", "<dl><dd><div>", "<table><tr><td>", "<ul><li>", "<script>", "<p>", "</p>"])
def test_broken_markup_of_a_megabyte(unit):
    import time

    n = (1 << 20) // len(unit) if unit not in ("<p><button><div>", "<dl><dd><div>") else 30_000
    for source in (unit * n, unit * n + ">", unit + "<div>" * 50_000):
        began = time.time()
        html_text.Page(source).text(lambda h: False)
        assert time.time() - began < 8


def test_markup_rules():
    text = lambda h: html_text.Page(h).text(lambda x: False)
    assert text("1 < 2 and 3 > 2 <b>x</b>") == "1 < 2 and 3 > 2 x"
    assert text("<p title='a > b'>x</p><p title=\"y>z</p>") == "x\n\nz"
    assert text("&#65;&#x41;&#000065;" + "&#" + "9" * 10_000 + ";") == "AAA\ufffd"
    assert text("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>") == "a\n\nb\n\nc\n\nd"
    assert text("<table><tr><td>a<td>b<table><tr><td>c</table><tr><td>d</table>") == "a\n\nb\n\nc\n\nd"
    assert text("<SCRIPT>a</script >b<![CDATA[ c<d ]]>e<!-- f") == "b c<d e"
    assert text("a <b") == "a <b"


def test_broken_markup_takes_linear_time():
    import time

    began = time.time()
    assert html_text.Page("<div>" * 50_000 + "x").text(lambda h: False) == "x"
    assert html_text.Page("<b>" * 50_000 + "</i>" * 50_000 + "y").text(lambda h: False) == "y"
    assert personal_data.Sites("x" * 200_000 + " 1").cores == ["1"]
    assert time.time() - began < 20


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.assess(docs, labels).count() == 0
    assert personal_data.find(docs).count() == 0 and personal_data.redact(docs).columns == docs.columns
    assert licences.scan(docs).count() == 0
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    one = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    assert quality.assess(one, labels).first().predicted == 1

def test_served_scores_are_those_of_training_and_outliers_are_cut():
    rng = np.random.default_rng(2)
    data = graded()
    model = quality.train([t for _, t, _ in data], [q for _, _, q in data])
    (part,) = slices(pa.array([" ".join(["word"] * 40), data[1][1]], pa.string()))
    buckets, bounds, dense = quality.features(part)
    for i in range(2):
        found, counts = np.unique(buckets[bounds[i] : bounds[i + 1]], return_counts=True)
        n = counts.sum()
        grouped = model.bias + quality.machine(model.word[found], counts / n, counts / n**2, np.array([0, len(found)]), model.scaled(dense[i : i + 1]), model.dense)[0]
        assert model.raw(buckets, bounds, dense)[i] == pytest.approx(grouped[0])
    far = dense + rng.normal(size=dense.shape) * 1e6
    assert np.abs(model.scaled(far)).max() <= quality.CLIP


def cleaned(source):
    return html_text.Page(source).text(lambda h: False)


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ('<article><div style="overflow:hidden"><p>Body</p></div></article>', "Body"),
        ('<article><p title="a hidden gem">A</p><p data-note="not hidden">B</p><p hidden>C</p><p hidden="">D</p><p HIDDEN>E</p></article>', "A\n\nB"),
        ("<article><p data-class='comment' aria-hidden=false>A</p><p class=x aria-hidden = true>B</p></article>", "A"),
        ('<div id="content"><p>main text</p></div><div class="comments-area"><ol class="comment-list"><li><article class="comment-body">Nice post!</article></li></ol></div>', "main text"),
        ("<p>page</p><aside><article>Teaser</article></aside>", "page"),
        ('<p>page</p><section class="related"><article>Teaser</article></section>', "page"),
        ('<p>page</p><article class="comment">c</article>', "page"),
        ('<article><p>a</p><article class="comment">c</article></article>', "a"),
        ('<article><p>a <span class="advert">b</span><code class="comment">c</code></p></article>', "a c"),
        ('<div class="popup"><article><p>all</p></article></div><footer>f</footer>', "all"),
        ('<div class="sidebar"><p>only this</p></div>', "only this"),
        ('<main class="has-ads"><article><p>a</p></article><article><p>b</p></article></main>', "a\n\nb"),
    ],
)
def test_attributes_and_articles_within_boilerplate(source, expected):
    assert cleaned(source) == expected


def test_heads_of_classes():
    for name in ("user-comments", "reader-comments", "post-comments", "left-sidebar-2", "share", "main-content_advert", "article-share-box"):
        assert cleaned(f"<article><p>a</p><div class='{name}'>b</div></article>") == "a", name
    for name in ("has-sidebar", "no-comments", "content-with-sidebar", "without-ads", "comments-policy", "shares-report"):
        assert cleaned(f"<article><p>a</p><div class='{name}'>b</div></article>") == "a\n\nb", name


def test_many_articles_and_deep_templates_take_linear_time():
    import time

    megabyte = "<body>" + "".join(f"<article><p>story {i} text</p><div>note</div></article>" for i in range(16_000)) + "</body>"
    for source in (megabyte, "<body><article>" + "<div>x" * 20_000, "<body>" + "<article><div>x" * 20_000):
        began = time.time()
        html_text.Page(source).text(lambda h: True)
        assert time.time() - began < 5


def test_random_pages_against_a_plain_walk():
    rng = random.Random(12)

    def grown(depth, inside):
        if depth > 3 or rng.random() < 0.3:
            return "p", rng.choice(["", "", "title='hidden nav'", "hidden"]), [f"word{rng.randrange(99)}"]
        tag = rng.choice(["div", "div", "section", "nav", "aside", "script"])
        children = ["var x"] if tag == "script" else [grown(depth + 1, inside) for _ in range(rng.randrange(1, 4))]
        return tag, rng.choice(["", "", "style=overflow:hidden", "class=comments", "data-x='class=comments '"]) if tag in ("div", "section") else "", children

    def shown(tree):
        tag, attributes, children = tree
        return f"<{tag} {attributes}>" + "".join(c if isinstance(c, str) else shown(c) for c in children) + f"</{tag}>"

    for i in range(400):
        article = ("article", "", [("p", "", ["story"]), *(grown(0, True) for _ in range(3))])
        around = [grown(0, False) for _ in range(2)]

        def walked(tree):
            tag, attributes, children = tree
            own = attributes.replace("data-x='class=comments '", "").replace("title='hidden nav'", "")
            if tag in ("nav", "aside", "script") or "class=comments" in own or "hidden" in own.split():
                return []
            return [x for c in children for x in ([c] if isinstance(c, str) else walked(c))]

        page_ = "".join(map(shown, [around[0], article, around[1]]))
        assert cleaned(page_) == "\n\n".join(walked(article)), (i, page_)


def test_quality_of_very_long_and_repeated_rows(spark):
    data = graded(200)
    long = " ".join(data[1][1] for _ in range(2000))
    docs = spark.createDataFrame([(i, t) for i, t, _ in data] + [(1, data[1][1]), (1, data[1][1]), (7001, long)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in data] + [(3, 1)] * 50, "doc_id long, quality int")
    got = quality.assess(docs, labels).collect()
    assert len(got) == 203 and len({r.score for r in got if r.doc_id == 1}) == 1
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.predicted == int(r.doc_id % 4 > 0) for r in got if r.doc_id < 200)


def test_scores_of_languages_by_a_plain_sum(spark):
    """A served score is the calibrated softmax of the mean of all rows of a text, word by word."""
    df = spark.createDataFrame(spoken(), "doc_id long, text string, lang string")
    model = langid.fit(df, F.lit(True))
    one = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(df, model, ["doc_id", "text"]).collect()}
    again = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(df.repartition(7).unionAll(df), model, ["doc_id", "text"]).collect()}
    assert one == again  # neither neighbours in a batch nor repeats change a score
    assert all(lang == one[i][0] for i, _, lang in spoken())
