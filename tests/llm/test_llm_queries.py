"""Registered queries over whole tables, and the pipeline, against SQL or plain versions."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_plain import jaccard, shingles
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from check_oracles import compare, duck
from tokenloom.llm import byte_bpe, oracles, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in sorted(rows)}


def rows_of(spark, name):
    return {r.doc_id: r for r in contract.queries()[name](spark, SF).collect()}


@pytest.mark.parametrize("name", list(oracles.SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(SF), SF, name) is None


def test_all_are_registered():
    numbers = {name.split("_")[0] for name in queries.QUERIES}
    assert numbers == {f"op{n}" for n in range(1, 14)}
    assert set(contract.queries()) >= {*queries.QUERIES, "pipeline"}


def test_edited_texts(spark, texts):
    got, ids = rows_of(spark, "op2_fingerprints"), list(texts)
    for n, i in enumerate(ids):
        text, after = texts[i], texts[ids[(n + 1) % len(ids)]]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].near_edited == pytest.approx(jaccard(shingles(text), shingles(edited)), abs=0.16)
        assert got[i].near_next == pytest.approx(jaccard(shingles(text), shingles(after)), abs=0.16)


def test_edited_texts_of_repeated_and_null_ids(spark, tmp_path):
    """One row per document; null ids come last, and equal ids follow each other in some order."""
    rows = [(1, "a b c d e f g h"), (2, "one two three four"), (2, "five six seven eight"), (3, None), (None, "x y z w " * 4), (None, "")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op2_fingerprints(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id or 9 for r in got) == [1, 2, 2, 3, 9, 9] and len({(r.doc_id, r.fingerprint) for r in got}) == 6
    # rows of one id keep the order of the table
    for n, (i, text) in enumerate(rows):
        text, after = text or "", rows[(n + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert (i, len(text), hashlib.sha256(edited.encode()).hexdigest()) in {(r.doc_id, r.n_chars, r.edited_sha256) for r in got}


def test_byte_bpe(spark, texts):
    with open(public_tokenizers.path(queries.RANKS), "rb") as file:
        codec = byte_bpe.encoding(file.read(), public_tokenizers.PATTERN)
    for i, row in rows_of(spark, "op5_byte_bpe").items():
        ids = codec.encode_ordinary(texts[i])
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[i].encode()).hexdigest()


def test_token_files(spark, texts):
    codec, at, got = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, rows_of(spark, "op6_token_files")
    for i, text in texts.items():
        ids = codec.encode(text, add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


@pytest.mark.parametrize(("name", "folds", "fold"), [("op7_language", 5, 0), ("op10_toxicity", 4, 2)])
def test_held_out_rows(spark, texts, name, folds, fold):
    got = rows_of(spark, name)
    assert set(got) == set(texts)
    for i, row in got.items():
        assert row.held_out == (zlib.crc32(str(i).encode()) % folds == fold) and 0 <= row.score <= 1


def test_near_copies_and_repeats(spark, texts):
    sets, got = {i: shingles(t) for i, t in texts.items()}, rows_of(spark, "op8_minhash")
    for i in texts:
        for j in texts:
            if i < j and (texts[i] == texts[j] or (sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= 0.8)):
                assert got[i].class_id == got[j].class_id <= i
    cut = rows_of(spark, "op9_suffixes")
    seen, data = {}, {i: t.encode() for i, t in texts.items()}
    for d in data.values():
        for p in range(len(d) - 199):
            seen[d[p : p + 200]] = seen.get(d[p : p + 200], 0) + 1
    for i, d in data.items():
        cover = bytearray(len(d))
        for p in range(len(d) - 199):
            if seen[d[p : p + 200]] > 1:
                cover[p : p + 200] = b"\1" * 200
        kept = bytes(b for b, c in zip(d, cover) if not c)
        assert (cut[i].n_bytes, cut[i].n_removed) == (len(d), sum(cover)) and cut[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_pipeline(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "byte_bpe"]
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, frames[-1], SF)
        frames.append(spark.createDataFrame(made.collect(), made.schema).cache())
        if len(frames) <= len(corpus_pipeline.STAGES):
            assert made.columns == docs.columns
    ids = [[r.doc_id for r in f.select("doc_id").collect()] for f in frames]
    assert set(ids[1]) <= set(texts) and len(ids[1]) > 0.6 * len(texts)  # a few dozen labels teach little
    first = {}
    for i in sorted(ids[1]):
        first.setdefault(texts[i], i)
    assert sorted(ids[2]) == sorted(first.values())
    for i in set(ids[2]) - set(ids[3]):
        assert any(jaccard(shingles(texts[i]), shingles(texts[j])) >= 0.8 for j in ids[2] if j < i)
    kept = sorted(ids[3])
    assert not any(jaccard(shingles(texts[i]), shingles(texts[j])) >= 0.8 for n, i in enumerate(kept) for j in kept[:n])
    assert set(ids[4]) <= set(ids[3]) and max(ids[4].count(i) for i in ids[4]) <= queries.MIX_EPOCHS
    assert sorted(ids[5]) == sorted(ids[4]) and frames[5].filter("not decodes").isEmpty()


def test_clean_documents_stay(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    kept = corpus_pipeline.drop_toxic(spark, docs, folder)
    counts = {r.toxic: (r.n, r.of) for r in labels.join(kept.select("doc_id", F.lit(1).alias("kept")), "doc_id", "left").groupBy("toxic").agg(F.count("kept").alias("n"), F.count(F.lit(1)).alias("of")).collect()}
    assert counts[0][0] >= 0.97 * counts[0][1] and counts[1][0] < 0.7 * counts[1][1]


@pytest.mark.parametrize("label", [0, 1, None])
def test_labels_that_teach_nothing_reject_nothing(spark, tmp_path, label):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.select("doc_id", F.lit(label).cast("int").alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == docs.count()


def test_pipeline_on_an_empty_table(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF)
    assert frame.count() == 0
