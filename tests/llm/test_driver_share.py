"""What the driver gets of training and of components: features and not texts, and no round that changes nothing."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import components, personal_data, quality
from eventloom.llm.jobs import drawn
from test_text_operators import graded


def spied(monkeypatch, module):
    seen, real = [], module.drawn
    monkeypatch.setattr(module, "drawn", lambda *a, **b: seen.extend(real(*a, **b)) or list(seen))
    return seen


def size(rows):
    return sum(len(v) for r in rows for v in r if isinstance(v, (str, bytes, bytearray)))


def test_training_reads_features_on_tasks(spark, monkeypatch):
    data = [(i, (t + " ") * 20 + f"call +4520{i:06d} or 20{i:06d} now", q) for i, t, q in graded(60)]
    docs = spark.createDataFrame([x[:2] for x in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in data], "doc_id long, quality int")

    seen = spied(monkeypatch, quality)
    model = quality.fit(docs, labels, F.lit(True))
    assert len(seen) == len(data) and "text" not in seen[0].__fields__ and size(seen) < 0.5 * sum(len(t) for _, t, _ in data)
    rows = drawn(docs.join(labels, "doc_id").select(F.col("quality").alias("label"), "text"), 100)
    same = quality.train([r.text for r in rows], [r.label for r in rows])
    assert np.array_equal(model.word, same.word) and np.array_equal(model.dense, same.dense) and (model.slope, model.shift) == (same.slope, same.shift)

    seen = spied(monkeypatch, personal_data)
    field = personal_data.fit(docs)
    assert len(seen) == len(data) and "text" not in seen[0].__fields__ and size(seen) < 0.5 * sum(len(t) for _, t, _ in data)
    same = personal_data.SkipChain().fit([r.text for r in drawn(docs.select("text"), 100)])
    assert same.unary.any() and all(np.array_equal(getattr(field, k), getattr(same, k)) for k in ("unary", "chain", "skip"))


@pytest.mark.parametrize(("edges", "tables"), [([], 1), ([(1, 2), (1, 3), (5, 9)], 1), ([(1, 2), (2, 3)], 2), ([(i, i + 1) for i in range(20)], None), ([random.Random(3).sample(range(60), 2) for _ in range(50)], None)])
def test_stars_take_no_round(spark, monkeypatch, edges, tables):
    made, real = [], components.written
    monkeypatch.setattr(components, "written", lambda df: made.append(1) or real(df))
    found = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    least = {x: x for e in edges for x in e}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert found == least and (tables is None or len(made) == tables)
