import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests import plain
from tests.test_ranking import seeded
from tokenloom import plans, sinks, sources, streaming
from tokenloom.constants import CHAT_TEMPLATE, SPECIAL_TOKENS
from tokenloom.functions.codec import Encoder
from tokenloom.operators import merges as merges_module, ranking, training_rows, vocabulary, wordstats
from tokenloom.operators.merges import Merge, learn_merges
from tokenloom.session import shared_path
from tokenloom.sinks import manifest

MERGES = [Merge(70, 71, 261, 9), Merge(261, 72, 262, 8)]


def lines_of(path):
    return "".join(p.read_text() for p in sorted(Path(path).glob("part-*"))).splitlines()


def test_jsonl_keeps_columns_and_flags_broken_lines(spark, tmp_path):
    df = spark.createDataFrame([("1", "a\nb", None), ("2", "", "é")], "id string, text string, title string")
    sinks.write_jsonl(df, f"{tmp_path}/a")
    schema = "id string, text string, title string"
    assert sorted(sources.read_jsonl(spark, f"{tmp_path}/a", schema).collect(), key=lambda r: r.id) == df.collect()
    with pytest.raises(Exception):
        sinks.write_jsonl(df, f"{tmp_path}/a")
    sinks.write_jsonl(df.limit(1), f"{tmp_path}/a", mode="ignore")
    assert sources.read_jsonl(spark, f"{tmp_path}/a", schema).count() == 2
    (tmp_path / "broken.json").write_text('{"text": "ok"}\n{"text": \n')
    rows = sources.read_jsonl(spark, f"{tmp_path}/broken.json", "text string", keep_corrupt=True).collect()
    assert [(r.text, r._corrupt_record) for r in rows] == [("ok", None), (None, '{"text": ')]
    with pytest.raises(Exception):
        sources.read_jsonl(spark, f"{tmp_path}/broken.json", "text string").collect()


def test_subsets_prune_directories(spark, docs, tmp_path):
    docs.withColumnRenamed("lang", "subset").write.partitionBy("subset").parquet(f"{tmp_path}/t")
    frame = sources.read_subsets(spark, f"{tmp_path}/t", ["fr", "es"])
    assert {r.subset for r in frame.collect()} == {"fr", "es"}
    assert "PartitionFilters: [subset" in frame._jdf.queryExecution().executedPlan().toString()


def test_chunks_written_once(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}\nx\r") for i in range(10)], "id long, text string")
    chunked = ranking.corpus_chunks(df, 3, ranking.positional_order(df, "id"))
    path = f"{tmp_path}/c"
    assert sources.read_chunks(spark, path).count() == 0
    assert sinks.write_chunks(chunked, path, 3) == [0, 1, 2]
    assert sinks.write_chunks(chunked, path, 3) == [] and sinks.existing_chunks(spark, path, 3) == [0, 1, 2]
    rows = sources.read_chunks(spark, path).collect()
    assert len(rows) == 20 and {r.line for r in rows} == {f"t{i}\n" for i in range(10)} | {"x\r\n"}
    # two chunks anew, the third one stays where it is
    assert sinks.write_chunks(chunked.withColumn("text", F.lit("new")), path, 3, rewrite=[0, 2]) == [0, 2]
    lines = Counter((r.chunk, r.line) for r in sources.read_chunks(spark, path).collect())
    assert lines == {(0, "new\n"): 4, (2, "new\n"): 3, (1, "t4\n"): 1, (1, "t5\n"): 1, (1, "t6\n"): 1, (1, "x\r\n"): 3}
    sets = [p.name for p in Path(path).glob("set-*")]
    assert len(sets) == 2 and manifest.remove_unused(spark, path) == []
    sinks.write_chunks(chunked, path, 3, rewrite=[0, 1, 2])
    assert manifest.remove_unused(spark, path) == sorted(sets) and sources.read_chunks(spark, path).count() == 20


def test_a_killed_job_leaves_the_old_set_or_the_new_one(spark, tmp_path, monkeypatch):
    """A failure before and after every step that touches files."""
    df = spark.createDataFrame([(i, f"t{i}") for i in range(12)], "id long, text string")
    chunked = ranking.corpus_chunks(df, 3, ranking.positional_order(df, "id"))
    new = chunked.withColumn("text", F.concat(F.lit("new "), "text"))
    path = f"{tmp_path}/c"
    sinks.write_chunks(chunked, path, 3)
    old = {f"t{i}\n" for i in range(12)}

    class Killed(BaseException):
        pass

    for name in ("new_folder", "commit", "_publish"):
        for late in (False, True):
            real = getattr(manifest, name)

            def kill(*args, real=real, late=late):
                if late:
                    real(*args)
                raise Killed

            with monkeypatch.context() as patch:
                patch.setattr(manifest, name, kill)
                with pytest.raises(Killed):
                    sinks.write_chunks(new, path, 3, rewrite=[0, 1, 2])
            lines = {r.line for r in sources.read_chunks(spark, path).collect()}
            published = late and name in ("commit", "_publish")
            assert lines == ({f"new {x}" for x in old} if published else old)
            sinks.write_chunks(chunked, path, 3, rewrite=[0, 1, 2])
    # torn files of a dead job and a half-written version are not seen
    Path(path, "set-dead", "chunk=0").mkdir(parents=True)
    Path(path, "set-dead", "chunk=0", "part-half.txt").write_text("torn")
    Path(path, "_versions", ".half").write_text("{")
    assert {r.line for r in sources.read_chunks(spark, path).collect()} == old
    version, content = manifest.current(spark, path)
    with pytest.raises(manifest.Conflict):
        manifest.commit(spark, path, version, content)
    assert manifest.current(spark, path) == (version, content)


def test_vocabulary_files(spark, tmp_path):
    vocab, table = vocabulary.vocab_table(spark, MERGES), merges_module.merges_table(spark, MERGES)
    sinks.write_vocab_json(vocab, f"{tmp_path}/v")
    stored = json.loads("".join(lines_of(f"{tmp_path}/v")))
    tokens = vocabulary.token_texts(MERGES)
    assert stored == {t: i for i, t in enumerate(tokens)} and list(stored) == tokens
    back = {r.token: r.id for r in sources.read_vocab_json(spark, f"{tmp_path}/v").collect()}
    assert back == stored
    sinks.write_merges_text(table, vocab, f"{tmp_path}/m")
    assert lines_of(f"{tmp_path}/m") == ["#version: 0.2", f"{tokens[70]} {tokens[71]}", f"{tokens[261]} {tokens[72]}"]


def test_settings_file(spark, tmp_path):
    sinks.write_settings(spark, f"{tmp_path}/s")
    stored = json.loads(lines_of(f"{tmp_path}/s")[0])
    assert len(stored) == 17 and stored["chat_template"] == CHAT_TEMPLATE
    assert [stored["added_tokens_decoder"][str(i)]["content"] for i in range(5)] == SPECIAL_TOKENS
    assert stored["added_tokens_decoder"]["2"] == {
        "content": "<pad>", "lstrip": False, "normalized": False, "rstrip": False, "single_word": False, "special": True
    }
    assert stored["pad_token"] is None and stored["model_max_length"] == 1000000000000000019884624838656
    assert stored["additional_special_tokens"] == [] and stored["sp_model_kwargs"] == {}


def jsonl_files(spark, tmp_path, rows, schema):
    for i in range(3):
        spark.createDataFrame(rows[i::3], schema).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    return f"{tmp_path}/in"


def test_pretrain_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"text number {i} " * (i % 5)) for i in range(30)]
    path = jsonl_files(spark, tmp_path, rows, "id long, text string")
    encoder = Encoder(spark, MERGES)
    batch = training_rows.pretrain_rows(
        sources.read_jsonl(spark, path, "id long, text string"), encoder, 32, keep=("id",)
    ).collect()
    args = (spark, path, f"{tmp_path}/out", f"{tmp_path}/progress", encoder, 32)
    more = dict(keep_schema="id long", keep=("id",), files_per_trigger=1)
    streaming.stream_pretrain(*args, **more)
    assert sorted(spark.read.parquet(f"{tmp_path}/out").collect()) == sorted(batch)
    # a restart from the checkpoint adds nothing, a new file adds its rows
    streaming.stream_pretrain(*args, **more)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 30
    spark.createDataFrame([(99, "new")], "id long, text string").write.mode("append").json(path)
    streaming.stream_pretrain(*args, **more)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 31


@pytest.mark.parametrize("compat", [False, True])
def test_instruct_stream_equals_batch(spark, tmp_path, compat):
    rows = [(i, "be kind" if i % 3 else None, f"ask {i}", f"answer {i} " * (i % 7)) for i in range(30)]
    schema = "id long, instruct string, input string, output string"
    path = jsonl_files(spark, tmp_path, rows, schema)
    encoder = Encoder(spark, MERGES)
    batch = training_rows.instruct_rows(sources.read_jsonl(spark, path, schema), encoder, 48, compat, keep=("id",)).collect()
    for _ in range(2):
        streaming.stream_instruct(
            spark, path, f"{tmp_path}/out", f"{tmp_path}/progress", encoder, 48, compat, keep_schema="id long", keep=("id",)
        )
        assert sorted(spark.read.parquet(f"{tmp_path}/out").collect()) == sorted(batch)


def test_stream_sets_rejects_apart(spark, tmp_path):
    rows = [(i, "sys", f"ask {i}", None if i % 4 == 0 else "yes") for i in range(20)]
    path = jsonl_files(spark, tmp_path, rows, "id long, instruct string, input string, output string")
    streaming.stream_instruct(
        spark, path, f"{tmp_path}/out", f"{tmp_path}/progress", Encoder(spark, MERGES), 24, keep_schema="id long", keep=("id",),
        rejects=f"{tmp_path}/bad",
    )
    assert {r.id for r in spark.read.parquet(f"{tmp_path}/bad").collect()} == set(range(0, 20, 4))
    assert {r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {i for i in range(20) if i % 4}


@pytest.mark.parametrize("broken_at", [0, 1, 2, 3, 4])
def test_two_outputs_of_one_read_survive_a_restart(spark, tmp_path, monkeypatch, broken_at):
    """A failure before each write of either output: after a restart both are whole, and every line was read once per try."""
    (tmp_path / "in").mkdir()
    for n in range(3):
        lines = [json.dumps({"id": i, "text": None if i % 4 == 0 else f"t{i}"}) for i in range(n * 10, n * 10 + 10)]
        (tmp_path / "in" / f"part-{n}.json").write_text("\n".join([*lines, "{torn"]) + "\n")
    encoder, real, calls = Encoder(spark, MERGES), streaming.write_batch, []

    def failing(rows, out, number):
        calls.append(number)
        if len(calls) == broken_at:
            real(rows.limit(1), out, number)  # half of a write that died
            raise RuntimeError("lost")
        real(rows, out, number)

    def run():
        return streaming.stream_pretrain(
            spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/progress", encoder, 8, keep_schema="id long", keep=("id",),
            files_per_trigger=1, rejects=f"{tmp_path}/bad",
        )

    monkeypatch.setattr(streaming, "write_batch", failing)
    if broken_at:
        with pytest.raises(Exception, match="lost"):
            run()
    query = run()
    out = spark.read.parquet(f"{tmp_path}/out").collect()
    bad = spark.read.parquet(f"{tmp_path}/bad").collect()
    assert sorted(r.id for r in out) == [i for i in range(30) if i % 4] and {r.batch for r in out} == {0, 1, 2}
    assert Counter(r.reject_reason for r in bad) == {"no_text": 8, "broken_line": 3}
    if not broken_at:
        assert sum(p.numInputRows for p in query.recentProgress) == 33
    run()  # nothing is new
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(out) and len(calls) == 6 + (broken_at > 0) * (2 - broken_at % 2)


def test_rows_are_counted_while_rejects_are_written(spark, tmp_path):
    """The job reads its rows for the rejects, for the order and for the rows themselves, and not again to count them."""
    rows = spark.range(40).selectExpr("id", "if(id % 10 = 0, null, concat('text ', id)) as text")
    rows.write.parquet(f"{tmp_path}/in")
    stored = spark.read.parquet(f"{tmp_path}/in")
    good, usable = plans._write_rejects(stored, "pretrain", f"{tmp_path}/rejects")
    assert usable == good.count() == 36 and spark.read.parquet(f"{tmp_path}/rejects").count() == 4
    assert plans._write_rejects(stored.limit(0), "pretrain", f"{tmp_path}/none")[1] == 0


def test_corpus_job(spark, docs, tmp_path):
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("subset"))
    report = plans.build_corpus(rows, f"{tmp_path}/c", ["en", "fr", "es"], size=60)
    ids = {s: seeded([r.id for r in rows.filter(F.col("subset") == s).collect()])[:20] for s in ("en", "fr", "es")}
    assert {r.subset: r.rows for r in report.collect()} == {s: len(v) for s, v in ids.items()}
    stored = sources.read_jsonl(spark, f"{tmp_path}/c", "id long, subset string, text string").collect()
    assert {r.id for r in stored} == {i for v in ids.values() for i in v}
    with pytest.raises(ValueError, match="fewer than"):
        plans.build_corpus(rows, f"{tmp_path}/strict", ["en", "fr"], size=10**6, strict=True)


def test_instruct_job(spark, tmp_path):
    a = spark.createDataFrame([(i, f"i{i}", "", f"o{i}") for i in range(50)], "key long, instruction string, input string, output string")
    b = spark.createDataFrame(
        [(f"x{i}", i, "s", f"q{i}", f"r{i}") for i in range(50, 100)], "id string, key long, system_prompt string, question string, response string"
    )
    plans.build_instruct(plans.instruct_union(a, b), f"{tmp_path}/out", "key")
    schema = "key long, instruct string, input string, output string"
    train, valid = (sources.read_jsonl(spark, f"{tmp_path}/out/part={p}", schema).collect() for p in ("train", "test"))
    written = "".join(p.read_text() for p in sorted(Path(f"{tmp_path}/out/part=train").glob("part-*"))).splitlines()
    assert [json.loads(line)["key"] for line in written] == seeded(range(100))[5:]
    assert {r.key for r in valid} == set(seeded(range(100))[:5])
    assert sorted(r.key for r in train + valid) == list(range(100))
    assert {r.key: (r.instruct, r.input, r.output) for r in train + valid}[60] == ("s", "q60", "r60")


@pytest.mark.parametrize("compat", [False, True])
def test_tokenizer_job(spark, docs, tmp_path, compat):
    corpus = plans.tokenizer_corpus(docs, "doc_id", compat=compat)
    out = f"{tmp_path}/tok"
    learned = plans.train_tokenizer(corpus, out, vocab_size=300, min_frequency=5)
    half = seeded([r.doc_id for r in docs.collect()])[: round(docs.count() / 2)]
    size, rest = len(half) // 6, len(half) % 6
    copies = Counter()
    for chunk in range(6):
        picked = half[: size + (chunk < rest)] if compat else half[chunk * size + min(chunk, rest) :][: size + (chunk < rest)]
        copies.update(picked)
    repeated = spark.createDataFrame([(k,) for k, n in copies.items() for _ in range(n)], "doc_id long").join(docs, "doc_id")
    words = wordstats.symbol_words(wordstats.word_counts(wordstats.corpus_lines(repeated)))
    assert learned == learn_merges(words, 300, 5)
    assert spark.read.parquet(f"{out}/vocab").count() == 300
    text = docs.limit(20)
    loaded = plans.load_encoder(spark, out)
    direct = Encoder(spark, learned)
    for r in text.select(loaded.encode(F.col("text")).alias("a"), direct.encode(F.col("text")).alias("b")).collect():
        assert r.a == r.b


def test_tokenizer_job_extends_a_vocabulary(spark, docs, tmp_path):
    """The merges of the supplied vocabulary come first, what is learned goes on from them."""
    base = Merge(77, 70, 261, 9), Merge(261, 261, 262, 8), Merge(262, 262, 263, 7), Merge(225, 88, 264, 6)
    sinks.write_vocab_json(vocabulary.vocab_table(spark, base), f"{tmp_path}/base")
    out, corpus = f"{tmp_path}/tok", plans.tokenizer_corpus(docs, "doc_id")
    learned = plans.train_tokenizer(corpus, out, vocab_size=280, base=sources.read_vocab_json(spark, f"{tmp_path}/base"))
    words = Counter()
    for r in corpus.select("text").collect():
        words.update(w for line in r.text.split("\n") for w in plain.pretokens(line + "\n"))
    tokens = vocabulary.token_texts(base)
    assert learned == plain.train(words, 280, 5, dict(enumerate(tokens)), base) and len(learned) == 15
    rows = {r.id: r.token for r in spark.read.parquet(f"{out}/vocab").collect()}
    assert [rows[i] for i in range(265)] == tokens and max(rows) == 279 and len(rows) == 280
    merged = [*base, *learned]
    texts = [r.text for r in docs.limit(20).select("text").collect()]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in frame.select("i", plans.load_encoder(spark, out).encode(F.col("t"), template=False).alias("ids")).collect():
        assert r.ids == [i for w in plain.pretokens(texts[r.i]) for i in plain.encode_word(w, merged)]
    used = {i for r in frame.select(plans.load_encoder(spark, out).encode(F.col("t")).alias("ids")).collect() for i in r.ids}
    assert 264 in used and used & set(range(265, 280))


def test_hash_split_on_a_stream(spark, tmp_path):
    path = jsonl_files(spark, tmp_path, [(i, "t") for i in range(60)], "id long, text string")
    frame = ranking.split_hash(sources.stream_jsonl(spark, path, "id long, text string"), 0.3, "id")
    streaming.run_available(frame, f"{tmp_path}/out", f"{tmp_path}/progress")
    batch = ranking.split_hash(sources.read_jsonl(spark, path, "id long, text string"), 0.3, "id")
    assert sorted(spark.read.parquet(f"{tmp_path}/out").collect()) == sorted(batch.collect())


def test_tokenizer_sample(spark, docs):
    rows = docs.select("doc_id", F.col("lang").alias("subset"), F.col("source").alias("title"), "text")
    out = plans.tokenizer_sample(rows, ["fr", "en"], key="doc_id", fraction=0.2, dropped=("doc_id", "title"))
    assert out.columns == ["subset", "text", "chunk"]
    sizes = {s: -(-rows.filter(F.col("subset") == s).count() * 2 // 10) for s in ("fr", "en")}
    found = out.groupBy("subset").count().collect()
    assert {r.subset: r["count"] for r in found} == sizes
    # subsets follow each other: the smaller first subset lies in the first chunk alone
    assert {r.chunk for r in out.filter("subset = 'fr'").collect()} == {0}


@pytest.mark.parametrize("kind", ["pretrain", "instruct"])
def test_training_row_job(spark, tmp_path, kind):
    rows = spark.createDataFrame(
        [(i, f"t {i}" if i % 10 else None, "s", f"q{i}", None if i % 10 == 3 else f"a{i}") for i in range(100)],
        "id long, text string, instruct string, input string, output string",
    )
    plans.build_training_rows(rows, kind, Encoder(spark, MERGES), f"{tmp_path}/r", "id", 24, batch_rows=4, accumulation=2, max_steps=5)
    bad = {i for i in range(100) if (i % 10 == 0 if kind == "pretrain" else i % 10 == 3)}
    assert {r.id for r in spark.read.parquet(f"{tmp_path}/r/rejects").collect()} == bad
    made = spark.read.parquet(f"{tmp_path}/r/rows").orderBy("rank").collect()
    assert [r.id for r in made] == seeded(set(range(100)) - bad)[:40]
    assert Counter(r.step for r in made) == {s: 8 for s in range(5)}
    assert all(len(r.input_ids) == len(r.labels) == (23 if kind == "pretrain" else 24) for r in made)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir", spark.sparkContext.getCheckpointDir()))


def test_all_usable_rows_are_written_by_default(spark, tmp_path):
    rows = spark.range(60).selectExpr("id", "if(id % 10 = 0, null, concat('text ', id)) as text")
    args = (rows, "pretrain", Encoder(spark, MERGES))
    assert plans.build_training_rows(*args, f"{tmp_path}/all", "id", 16, batch_rows=4, accumulation=2) == 0
    assert spark.read.parquet(f"{tmp_path}/all/rows").count() == 54
    assert plans.build_training_rows(*args, f"{tmp_path}/cut", "id", 16, batch_rows=4, accumulation=2, max_steps=5) == 14
    assert spark.read.parquet(f"{tmp_path}/cut/rows").count() == 40


@pytest.mark.parametrize("named", [False, True])
def test_streams_write_no_row_that_batch_rejects(spark, tmp_path, named):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id": 1, "text": "ok"}\n{"id": 2, "text": null}\n{"id": 3, "te\n{"id": 4, "text": ""}\n')
    more = {"rejects": f"{tmp_path}/bad"} if named else {}
    streaming.stream_pretrain(
        spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/progress", Encoder(spark, MERGES), 16, keep_schema="id long", keep=("id",), **more
    )
    out = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(r.id for r in out) == [1, 4] and all(r.input_ids and r.labels for r in out)
    if named:
        bad = {r.reject_reason: r for r in spark.read.parquet(f"{tmp_path}/bad").collect()}
        assert set(bad) == {"no_text", "broken_line"} and bad["broken_line"]._corrupt_record == '{"id": 3, "te'


def test_broken_configuration_is_an_error(spark, tmp_path):
    (tmp_path / "chat").mkdir()
    (tmp_path / "chat" / "a.json").write_text('{"output": "ok"}\n{"output": \n')
    with pytest.raises(Exception):
        sources.read_config(spark, str(tmp_path), sources.ALPACA_SCHEMA, "chat").collect()


def test_sets_with_another_number_of_chunks(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(16)], "id long, text string")
    path = f"{tmp_path}/c"
    eight = ranking.corpus_chunks(df, 8, ranking.positional_order(df, "id"))
    assert sinks.write_chunks(eight, path, 8) == list(range(8))
    assert sorted(r.line for r in sources.read_chunks(spark, path).collect()) == sorted(f"t{i}\n" for i in range(16))
    other = df.withColumn("text", F.concat(F.lit("new "), "text"))
    two = ranking.corpus_chunks(other, 2, ranking.positional_order(other, "id"))
    assert sinks.write_chunks(two, path, 2) == [0, 1]
    assert sorted(r.line for r in sources.read_chunks(spark, path).collect()) == sorted(f"new t{i}\n" for i in range(16))
    assert sinks.existing_chunks(spark, path, 8) == [] and sinks.existing_chunks(spark, path, 2, "seed5") == []
    # more chunks than rows: some have no files
    few = ranking.corpus_chunks(df.limit(2), 5, ranking.positional_order(df.limit(2), "id"))
    assert sinks.write_chunks(few, path, 5, tag="few") == list(range(5)) and sources.read_chunks(spark, path).count() == 2


def test_joint_vocabulary_ends_at_its_size(spark, docs, tmp_path):
    """Reserved tokens and bytes are added to a base that lacks them, then what is learned, up to the size."""
    base = spark.createDataFrame([(f"own{i}", 300 + i) for i in range(5)], "token string, id int")
    learned = plans.train_tokenizer(plans.tokenizer_corpus(docs, "doc_id"), f"{tmp_path}/t", vocab_size=580, min_frequency=5, base=base)
    ids = [r.id for r in spark.read.parquet(f"{tmp_path}/t/vocab").collect()]
    assert sorted(ids) == list(range(300, 580)) and [m.new_id for m in learned] == list(range(566, 580))
