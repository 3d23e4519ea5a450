import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_plain import awkward
from tokenizers import Tokenizer

from tokenloom.llm import queries, token_files as files
from tokenloom.llm.common import materialise
from tokenloom.session import shared_path

FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "two  spaces", "x　 y", "a b c", " lead", "trail ", "<|endoftext|> stays text", "don't\n stop", "é ü 中文", "w " * 9000, "q" * 3000]


def huffman_cost(weights):
    heap, cost = list(weights), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def test_code_lengths():
    random.seed(2)
    weights = np.array([random.randint(1, 10**6) for _ in range(300)])
    assert int((files.code_lengths(weights, 40) * weights).sum()) == huffman_cost(weights)
    short = files.code_lengths(weights, 9)
    assert short.max() == 9 and (2.0**-short).sum() == 1.0
    assert files.code_lengths(np.array([7])).tolist() == [1] and len(files.code_lengths(np.zeros(0))) == 0
    assert files.code_lengths(np.ones(1000), 3).max() == 10


@pytest.mark.parametrize("symbols", [1, 2, 5, 400])
def test_code_round_trip(symbols):
    rng = np.random.default_rng(4)
    tokens = np.sort(rng.choice(50000, symbols, replace=False))
    code = files.Code(tokens, files.code_lengths(rng.integers(1, 10**7, symbols)))
    rows = [rng.choice(tokens, n) for n in (0, 1, 5000, 0, 1024, 1025, 33)]
    for row, (data, marks) in zip(rows, code.encode(rows)):
        assert len(marks) == -(-len(row) // files.STEP)
        sizes = np.array([min(files.STEP, len(row) - s) for s in range(0, len(row), files.STEP)], dtype="int64")
        got = files.decode_stretches(code.tables(), code.top, data, np.array(marks, dtype="int64"), sizes)
        assert got.tolist() == row.tolist()


def test_files(spark):
    ids = [9, -3, 4, 100, 7, 6, 5, 12, 11, 10, 55, 54, None]
    docs = awkward(spark, TEXTS, ids=[0] * 13).drop("doc_id")
    docs = spark.createDataFrame(list(zip(ids, TEXTS)), "doc_id long, text string").crossJoin(docs.select("hash", "row").limit(1))
    path = shared_path(spark, "test-files")
    files.write_token_files(materialise(files.encode_documents(docs, FILE), "ids"), path, block=100, parts=3)
    rows = sorted(files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    codec, at = Tokenizer.from_file(FILE), 0
    codec.encode_special_tokens = True
    assert [r.id for r in rows] == [None, *sorted(i for i in ids if i is not None)]
    for r in rows:
        want = codec.encode(TEXTS[ids.index(r.id)] or "", add_special_tokens=False).ids + [2]
        assert r.start == at and np.frombuffer(r.ids, "<u4").tolist() == want
        at += len(want)
    assert spark.read.parquet(f"{path}/blocks").count() > 3


def test_one_block_decodes_alone(spark):
    path = shared_path(spark, "test-files")
    docs = spark.range(40).selectExpr("id as doc_id", "repeat('some words ', cast(id as int)) as text")
    files.write_token_files(materialise(files.encode_documents(docs, FILE), "ids"), path, block=50, parts=2)
    all_blocks = spark.read.parquet(f"{path}/blocks")
    one = shared_path(spark, "test-files")
    all_blocks.orderBy("part", "block").limit(1).write.parquet(f"{one}/blocks")
    spark.read.parquet(f"{path}/codes").write.parquet(f"{one}/codes")
    whole = {r.id: bytes(r.ids) for r in files.read_token_files(spark, path).collect()}
    part = {r.id: bytes(r.ids) for r in files.read_token_files(spark, one).collect()}
    assert 0 < len(part) < len(whole) and all(whole[i] == v for i, v in part.items())


def test_empty_table(spark):
    path = shared_path(spark, "test-files")
    docs = spark.createDataFrame([], "doc_id long, text string")
    files.write_token_files(materialise(files.encode_documents(docs, FILE), "ids"), path)
    assert files.read_token_files(spark, path).count() == 0


def test_added_tokens_in_texts_as_the_library_has_them(spark, tmp_path):
    texts = [*TEXTS, "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "w " * 40000 + "<|endoftext|>  z", "<|endoftext |>"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    codec, at = Tokenizer.from_file(FILE), 0
    rows = sorted(queries.op6_token_files(spark, str(tmp_path)).collect())
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    for r in rows:
        want = codec.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        at += len(want)
    assert codec.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]


def test_many_pieces_go_to_the_library_in_one_call():
    with open(FILE, encoding="utf-8") as file:
        codec = files.tokenizer(file.read(), False)

    class Counted:
        normalizer, pre_tokenizer, get_vocab, rows = None, codec.pre_tokenizer, codec.get_vocab, 0

        def encode_batch_fast(self, rows, **options):
            self.rows += len(rows)
            return codec.encode_batch_fast(rows, **options)

    added = [t.content for t in codec.get_added_tokens_decoder().values()]
    odd = ["", " ", " a\n", " \n\nb", "c", " é中\U0001f600", " d ", "  ", " 'll", " x\tY", " e\x1c", " e\x0b", " e\x85"]
    pieces = [f" w{i}q{i * i}" for i in range(5000)]
    for some in (pieces, [*odd, *pieces[:50], *added, *[f" {t}" for t in added], *odd[::-1]]):
        counted, want = Counted(), [codec.encode(p, add_special_tokens=False).ids for p in some]
        flat, lengths = files.encode_pieces(counted, pa.array(some, pa.large_string()), 64)
        assert lengths.tolist() == [len(w) for w in want]
        assert flat.tolist() == [i for w in want for i in w]
        assert len(some) < 5000 or counted.rows == 79
