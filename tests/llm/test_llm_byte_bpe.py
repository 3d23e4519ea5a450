import public_tokenizers
import pytest
from llm_plain import awkward
from pyspark.sql import functions as F

from tokenloom.llm import byte_bpe

TEXTS = [
    None, "", " ", "don't   stop\n\n now ", "a" * 3000, "中文 текст عربى \U0001f600", "<|endoftext|>", "  lead  　x", "x y " * 30000,
]


@pytest.fixture(scope="module")
def codec(spark):
    return byte_bpe.BytePairCodec(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def whole():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return byte_bpe.encoding(file.read(), public_tokenizers.PATTERN)


def test_ids_and_round_trip(spark, codec, whole):
    docs = awkward(spark, TEXTS)
    encoded = byte_bpe.encode_documents(docs, codec, out="made")
    rows = encoded.withColumn("back", codec.decode(F.col("made"))).orderBy("doc_id").collect()
    assert encoded.columns == [*docs.columns, "made"]
    for row, text in zip(rows, TEXTS):
        assert row.made == whole.encode_ordinary(text or "")
        assert bytes(row.back) == (text or "").encode()


def test_pieces_do_not_change_ids(whole):
    text = "It's 12  spaces,\n\n\n and   more.'s 've a\tb  c   d\r\n e" * 40
    want = whole.encode_ordinary(text)
    for size in (1, 2, 3, 7, 50):
        assert "".join(byte_bpe.pieces(text, size)) == text
        assert byte_bpe.encode_text(whole, text, size).tolist() == want


def test_bytes_that_are_not_utf8(spark, codec):
    row = spark.sql("select cast(x'61ff62' as string) as text").select(codec.decode(codec.encode(F.col("text"))).alias("b")).first()
    assert bytes(row.b).decode() == "a�b"


def test_null_ids_and_empty_table(spark, codec):
    rows = spark.createDataFrame([(None,), ([],)], "ids array<int>").select(codec.decode(F.col("ids")).alias("b"), byte_bpe.ids_sha256("ids").alias("s"))
    assert [r.b for r in rows.collect()] == [None, b""]
    assert byte_bpe.encode_documents(awkward(spark, TEXTS).limit(0), codec).count() == 0
