import random

import numpy as np
import pytest
from llm_plain import awkward
from pyspark.sql import functions as F

from tokenloom.llm import toxicity

BAD = ["vilewort", "scumbag", "trashy", "dolthead"]


def sentences(rng, n, toxic):
    out = ["".join(rng.choice(["ka", "lo", "mi", "ten", "ra", "shu"]) for _ in range(rng.randrange(1, 5))) for _ in range(n)]
    for _ in range(rng.randrange(1, 4) if toxic else 0):
        out[rng.randrange(n)] = rng.choice(BAD) + rng.choice(["", "s", ","])
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(12)
    labels = [int(rng.random() < 0.2) for _ in range(1500)]
    texts = [sentences(rng, rng.randrange(20, 200), label) for label in labels]
    docs = awkward(spark, texts).cache()
    table = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int").cache()
    return docs, table


@pytest.fixture(scope="module")
def model(corpus):
    docs, labels = corpus
    return toxicity.fit_toxicity(docs, labels.filter(toxicity.learnable(F.col("doc_id"), 4, 2)))


def test_held_out_accuracy(corpus, model):
    docs, labels = corpus
    rows = toxicity.score_documents(docs, model).join(labels, "doc_id").filter(~toxicity.learnable(F.col("doc_id"), 4, 2)).collect()
    high = [r.toxicity.score >= 0.3 for r in rows]
    assert len(rows) > 300
    assert np.mean([h == bool(r.toxic) for h, r in zip(high, rows)]) > 0.95
    caught = [r for r, h in zip(rows, high) if h and r.toxic]
    assert np.mean([any(r.toxicity.word.startswith(b) for b in BAD) for r in caught]) > 0.9


def test_awkward_texts(spark, model):
    rows = toxicity.score_documents(awkward(spark, [None, "", "  ", "scumbag", "x" * 100_000, "scumbag " * 3000, "y" * 60 + "scumbag" * 30]), model).collect()
    scores = [r.toxicity.score for r in rows]
    assert scores[0] == scores[1] == scores[2] < 0.3 <= min(scores[3], scores[5])
    assert all(0 <= s <= 1 for s in scores)


def test_reruns_agree(corpus, model):
    docs, labels = corpus
    again = toxicity.fit_toxicity(docs, labels.filter(toxicity.learnable(F.col("doc_id"), 4, 2)))
    assert (again.toxic, again.ordinary) == (model.toxic, model.ordinary) and again.weights == pytest.approx(model.weights)


def test_too_few_labels_and_empty_table(spark, corpus):
    docs, labels = corpus
    no_toxic = toxicity.fit_toxicity(docs, labels.filter("toxic = 0"))
    assert toxicity.score_documents(docs.limit(3), no_toxic).first().toxicity.score == 0.0
    nothing = toxicity.fit_toxicity(docs, labels.withColumn("toxic", F.lit(None).cast("int")))
    assert toxicity.score_documents(docs.limit(3), nothing).first().toxicity.score == 0.0
    few = toxicity.fit_toxicity(docs.limit(8), spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int"))
    assert toxicity.score_documents(docs.limit(0), few).count() == 0 and toxicity.score_documents(docs.limit(5), few).count() == 5
