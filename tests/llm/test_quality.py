"""Held-out accuracy of the classifier on graded random text, and on the driver's labels."""

import random
import re

import numpy as np
import pyarrow as pa
from helpers import clashing, prose

from marketstream.llm import quality
from marketstream.llm.common import table


def graded(rng, grade):
    text = re.sub("[0-9]+", "", prose(rng, 5))
    if grade == 0:
        return text.replace(" ", " dreadful ", 2)
    return " ".join(w + "***" for w in text.split()) if grade == 1 else text


def test_held_out_grades():
    rng = random.Random(6)
    grades = np.array([rng.choice([0, 1, 2, 2]) for _ in range(900)])
    texts = [graded(rng, g) for g in grades]
    flat, first = quality.features(pa.array(texts[:600]))
    model = quality.fit_arrays(flat, first, grades[:600], 3)
    tails = model.tails(pa.array(texts[600:]))
    assert model.thresholds[0] < model.thresholds[1] and (tails[:, 0] >= tails[:, 1]).all()
    assert ((tails >= 0.5).sum(axis=1) == grades[600:]).mean() > 0.97


def test_gradient_reaches_the_shares_without_features():
    grades = np.array([0] * 10 + [1] * 30 + [2] * 60)
    model = quality.fit_arrays(np.zeros(0, np.int64), np.zeros(101, np.int64), grades, 3)
    got = quality.logistic(-model.thresholds)
    assert np.allclose(got, [0.9, 0.6], atol=0.02)


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), quality.grades(table(spark, sf, "labels"))
    fitted = labels.filter("doc_id % 4 <> 0")
    model = quality.fit(docs, fitted, quality.N_GRADES)
    rows = quality.scores(docs, model).join(labels.filter("doc_id % 4 = 0"), "doc_id").collect()
    good = [r["kept"] for r in rows if r["grade"] == 2]
    toxic = [r["kept"] for r in rows if r["grade"] == 0]
    assert len(rows) > 80 and np.mean(good) > 0.9 and np.mean(toxic) < 0.5
    again = quality.fit(docs.repartition(5), fitted, quality.N_GRADES)
    assert np.array_equal(model.weights, again.weights)


def test_odd_rows(spark, odd, empty):
    ratings = spark.createDataFrame([(1, 2), (2, 0), (2, 2), (3, None), (4, 9), (5, 1), (99, 0), (None, 1)], "doc_id bigint, grade int")
    model = quality.fit(odd, ratings, 3)
    docs = clashing(odd, "tails", "_tails", "kept")
    rows = quality.scores(docs, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["p_grade_2"] <= r["p_grade_1"] <= 1 for r in rows)
    assert quality.accepted(docs, model).columns == docs.columns
    blind = quality.fit(empty, ratings, 3)
    assert quality.accepted(odd, blind).count() == odd.count()
    assert quality.scores(empty, model).collect() == []
