"""Every pipeline stage against a plain version of what it is for."""

import random

import numpy as np
import pytest

import corpus_pipeline
import public_tokenizers
from eventloom.llm import personal_data, set_join
from test_corpus_operators import slow_components, slow_matches
from test_text_operators import graded, slow_spans


@pytest.fixture(scope="module")
def corpus_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    rng = random.Random(9)
    rows = [(i, t, "en", "s", len(t)) for i, t, _ in graded(300)]
    item = " ".join(f"item{i}" for i in range(30))
    rows += [(1000, rows[1][1], "en", "s", 1), (1001, rows[2][1] + " " + item, "en", "s", 1), (1002, rows[3][1] + " mail someone@example.com soon", "en", "s", 1), (1003, None, None, None, None)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, _, q in graded(300)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages(spark, corpus_dir):
    docs = spark.read.parquet(f"{corpus_dir}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "jaccard", "decontamination", "personal_data", "bpe"]

    kept = stages["quality"](spark, docs, corpus_dir).cache()
    assert kept.columns == columns
    good = {i for i, _, q in graded(300) if q}
    ids = {r.doc_id for r in kept.collect()}
    assert good <= ids and not ids & {i for i, _, q in graded(300) if not q}

    rows = [(r.doc_id, r.text) for r in kept.collect()]
    unique = stages["jaccard"](spark, kept, corpus_dir).cache()
    expected = slow_components(rows, set_join.Rule(5, 80, 100))
    assert unique.columns == columns and {r.doc_id for r in unique.collect()} == {i for i, (_, c) in expected.items() if c == i}

    rows = [(r.doc_id, r.text) for r in unique.collect()]
    clean = stages["decontamination"](spark, unique, corpus_dir).cache()
    bad = {d for d, _ in slow_matches(rows, [(1, " ".join(f"item{i}" for i in range(30)))], 0.8)}
    assert bad == {1001} and {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - bad

    redacted = stages["personal_data"](spark, clean, corpus_dir).cache()
    assert redacted.columns == columns
    texts = {r.doc_id: (r.text, r.n_chars) for r in redacted.collect()}
    for doc, text in ((r.doc_id, r.text) for r in clean.collect()):
        expected_text = None if text is None else personal_data.hidden(text, slow_spans(text))
        assert texts[doc] == (expected_text, None if text is None else len(expected_text))

    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    theirs.no_truncation(), theirs.no_padding()
    encoded = stages["bpe"](spark, redacted, corpus_dir).collect()
    assert len(encoded) == len(texts)
    for r in encoded:
        assert np.frombuffer(r.ids, np.uint32).tolist() == theirs.encode(texts[r.doc_id][0] or "", add_special_tokens=False).ids

    whole = corpus_pipeline.run(spark, corpus_dir)
    assert {(r.doc_id, r.ids_sha256) for r in whole.collect()} == {(r.doc_id, r.ids_sha256) for r in encoded}


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, labels string, component_id long"


def stored(spark, folder, rows, labels, items):
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_repeats_null_ids_and_clashing_columns(spark, tmp_path):
    item = " ".join(f"item{i}" for i in range(30))
    more = lambda n: (0.5, "x", -n)  # noqa: E731  columns named as those of the stages' own tables
    rows = [(i, t, "en", "s", len(t), *more(i)) for i, t, _ in graded(200)]
    good = [r for r in rows if r[0] % 4]
    long = " ".join(f"w{i % 977}x{i % 1013}" for i in range(60_000))
    extra = [good[0], good[0], (None, good[1][1], None, None, None, *more(1)), (None, good[1][1], None, None, None, *more(1)), (None, None, None, None, None, None, None, None), (5000, None, None, None, None, None, None, None), (5001, "", "en", "s", 0, *more(2))]
    extra += [(5002, long, "en", "s", len(long), *more(3)), (5003, " ".join([*reversed(good[2][1].split()), item]) + ".", "en", "s", 1, *more(4)), (5004, long, "en", "s", len(long), *more(5))]
    folder = stored(spark, tmp_path, rows + extra, [(i, q, 0) for i, _, q in graded(200)] + [(None, 1, 0), (1, 1, 0)], [(1, item), (1, item), (None, item), (2, None)])
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "bpe":
            assert out.columns == docs.columns, name
            out = out.cache()
            kept.append({r.doc_id for r in out.collect()})
        docs = out
    ids = [r.doc_id for r in docs.collect()]
    assert {r[0] for r in rows if r[0] % 4} & kept[0] == {r[0] for r in rows if r[0] % 4} and None in kept[0]
    assert ids.count(good[0][0]) == 1  # rows of one id are one document
    assert ids.count(None) == sum(r.doc_id is None for r in corpus_pipeline.run(spark, folder).collect()) >= 2  # rows without an id stay
    assert 5004 not in kept[1] and 5003 in kept[1] and 5003 not in kept[2]


def test_empty_tables(spark, tmp_path):
    folder = stored(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, folder).collect() == []
    folder = stored(spark, tmp_path / "unlabelled", [(1, "a few words here", "en", "s", 16, None, None, None)], [], [])
    assert [r.doc_id for r in corpus_pipeline.run(spark, folder).collect()] in ([1], [])
