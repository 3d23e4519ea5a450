import numpy as np
import pyarrow as pa
import pytest
from llm_plain import awkward
from pyspark.sql import functions as F

from tokenloom.llm import language
from tokenloom.llm.toxicity import learnable

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def model(documents):
    russian = documents.limit(30).withColumn("lang", F.lit("ru")).withColumn("text", F.translate(F.lower("text"), "abcdefghijklmnopqrstuvwxyz", "абцдефгхийклмнопярстуввхыз"))
    return language.fit_languages(documents.filter(learnable(F.col("doc_id"), 5, 0)).unionByName(russian))


def test_held_out_accuracy(documents, model):
    rows = language.identify_documents(documents.filter(~learnable(F.col("doc_id"), 5, 0)), model).select("lang", "language").collect()
    assert len(rows) > 100
    assert np.mean([r.lang == r.language.lang for r in rows]) > 0.97
    assert all(0 <= r.language.score <= 1 for r in rows)


def test_mixed_text_gets_spans(documents, model):
    texts = {r.lang: r.text for r in documents.filter("length(text) between 300 and 500").collect()}
    whole = texts["en"] + " " + texts["de"] + " ПОМОСТ ДОМА " + texts["fr"]
    (row,) = language.identify(model, pa.array([whole])).to_pylist()
    assert [s["lang"] for s in row["spans"]] == ["en", "de", "ru", "fr"]
    assert row["spans"][1]["begin"] == pytest.approx(len(texts["en"]) + 1, abs=25)


def test_no_letters(spark, model):
    rows = language.identify_documents(awkward(spark, [None, "", "12 !!", "\U0001f600"]), model).collect()
    assert [(r.language.lang, r.language.score, r.language.spans) for r in rows] == [("und", 0.0, [])] * 4


def test_best_path_equals_trying_all():
    rng = np.random.default_rng(5)
    counts = np.array([4, 0, 6, 1])
    scores = rng.normal(size=(counts.sum(), 3)).astype("float32")
    got, at = language.best_path(scores, counts, 0.7), 0
    for n in counts:
        own = scores[at : at + n]
        paths = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), -1).reshape(-1, n) if n else np.zeros((1, 0), int)
        value = [sum(own[i, p[i]] for i in range(n)) - 0.7 * sum(p[i] != p[i - 1] for i in range(1, n)) for p in paths]
        assert got[at : at + n].tolist() == paths[int(np.argmax(value))].tolist()
        at += n


def test_no_labels_and_empty_table(spark, model):
    docs = awkward(spark, ["some text"]).withColumn("lang", F.lit(None).cast("string"))
    empty = language.fit_languages(docs)
    assert language.identify_documents(docs, empty).first().language.lang == "und"
    assert language.identify_documents(docs.limit(0), model).count() == 0


def test_long_words_and_marks(model):
    rows = language.identify(model, pa.array(["x" * 200_000, "éé the the the"])).to_pylist()
    assert rows[0]["spans"][0]["end"] == 200_000 and rows[1]["lang"] != "und"


def test_a_language_whose_sample_is_one_empty_text(spark):
    """Texts shorter than an n-gram, alone in their batch."""
    for texts in (["some english words here", ""], ["some english words here", "a"], ["some english words here", None], ["", ""]):
        rows = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(zip(texts, ["en", "fr"]))], "doc_id long, text string, lang string")
        model = language.fit_languages(rows.repartition(2, "lang"))
        found = language.identify_documents(rows, model).select("language.lang").collect()
        assert len(found) == 2 and all(r.lang in {"en", "fr", "und"} for r in found)
