"""One query per operator. Each reads whole tables; array results are returned as text."""

from __future__ import annotations

from functools import lru_cache, partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalog.inputs import alpaca_source, documents, instruct_source, orca_source, spread_documents, table
from tokenloom import plans, sinks, sources, streaming
from tokenloom.constants import FIRST_MERGE_ID, MAX_SEQ_LEN, MIN_FREQUENCY, SPECIAL_TOKENS, VOCAB_SIZE
from tokenloom.functions import bytelevel, chat, pretokens, sequences
from tokenloom.functions.codec import Encoder, decode_ids
from tokenloom.operators import batches, chat as chat_ops, columns, merges, places, ranking, recovery, training_rows, vocabulary, wordstats
from tokenloom.session import shared_path
from tokenloom.sinks import steps
from tokenloom.streaming import replay

# Merges learned where a query with SQL needs a trained tokenizer; the SQL has a table per merge.
LEARNED = 24
BASE_LEARNED = 12
# Merges of the queries whose SQL learns in a recursion.
HUNDREDS = 500
LANGUAGES = ["de", "en", "es", "fr"]
SAMPLE_ROWS = 100
CHUNKS = 6
SEGMENT_TURNS = 256
MAX_STEPS = 2
EPOCHS = 2
# Bounds that make merge learning halve, grow and checkpoint on small tables.
SMALL_PAIRS, SMALL_RUNS, SMALL_SYMBOLS = 16, 2000, 20_000


class Sizes(NamedTuple):
    """What a query learns: merges of the documents and of the base vocabulary, least count of a pair, size of a joint vocabulary, bounds."""

    learned: int
    base: int
    min_frequency: int
    joint: int
    bounds: tuple[int, int, int]


CHECKED = Sizes(LEARNED, BASE_LEARNED, 2, FIRST_MERGE_ID + BASE_LEARNED + 3, (SMALL_PAIRS, SMALL_RUNS, SMALL_SYMBOLS))
PUBLISHED = Sizes(
    VOCAB_SIZE - FIRST_MERGE_ID, VOCAB_SIZE - FIRST_MERGE_ID, MIN_FREQUENCY, VOCAB_SIZE,
    (SMALL_PAIRS, merges.MOST_RUNS // 10, merges.MOST_SYMBOLS // 10),
)
RECURSIVE = Sizes(HUNDREDS, BASE_LEARNED, 2, FIRST_MERGE_ID + BASE_LEARNED + 3, (SMALL_PAIRS, SMALL_RUNS, SMALL_SYMBOLS))
# Letters that take the place of a to z.
CYRILLIC = "абцдефгхийклмнопярстуввхыз"
ARABIC = "ابتثجحخدذرزسشصضطظعغفقكلمنه"
HAN = "一二三四五六七八九十百千上下左右大小中日月水火木金土"


def text_of(array: Column) -> Column:
    return F.concat_ws(",", array.cast("array<string>"))


def _words(df: DataFrame) -> DataFrame:
    return wordstats.symbol_words(wordstats.word_counts(wordstats.corpus_lines(df), batched=True))


@lru_cache(maxsize=8)
def _learned(spark: SparkSession, sf_dir: str, sizes: Sizes = CHECKED, base: bool = False) -> tuple[merges.Merge, ...]:
    """Merges of the documents, or of the texts that the base vocabulary comes from."""
    words = _words(table(spark, sf_dir, "benchmark" if base else "documents"))
    count = sizes.base if base else sizes.learned
    return tuple(merges.learn_merges(words, vocab_size=FIRST_MERGE_ID + count, min_frequency=sizes.min_frequency))


@lru_cache(maxsize=8)
def _encoder(spark: SparkSession, sf_dir: str, sizes: Sizes = CHECKED) -> Encoder:
    return Encoder(spark, _learned(spark, sf_dir, sizes))


@lru_cache(maxsize=4)
def _supplied(spark: SparkSession, sf_dir: str, sizes: Sizes = CHECKED) -> tuple[DataFrame, recovery.Base]:
    """A vocabulary of which only tokens and ids are known, and what is recovered from them."""
    made = vocabulary.vocab_table(spark, _learned(spark, sf_dir, sizes, base=True))
    known = recovery.complete(vocabulary.vocab_from_map(made.select("token", "id")))
    return known, recovery.base_of(known)


@lru_cache(maxsize=4)
def _learned_after(spark: SparkSession, sf_dir: str, sizes: Sizes = CHECKED) -> tuple[merges.Merge, ...]:
    """Merges of the documents that come after those of the supplied vocabulary."""
    base, words = _supplied(spark, sf_dir, sizes)[1], _words(documents(spark, sf_dir))
    size = max(base.texts) + 1 + sizes.learned
    return tuple(merges.learn_merges(words, size, sizes.min_frequency, base=base))


# sources and sinks


def scan_subsets(spark, sf_dir):
    rows = sources.read_subsets(spark, f"{sf_dir}/documents.parquet", ["en", "fr", "es"], "lang")
    return rows.select("doc_id", "lang", "text")


def scan_instruct(spark, sf_dir):
    """All instruct rows, stored as one named configuration and read back."""
    path = shared_path(spark, "instruct")
    rows = columns.rename_columns(instruct_source(spark, sf_dir), {"instruct": "instruction"})
    sinks.write_jsonl(rows.select("instruction", "input", "output"), f"{path}/chat")
    return sources.read_config(spark, path, sources.ALPACA_SCHEMA, "chat")


def jsonl_roundtrip(spark, sf_dir):
    path = shared_path(spark, "jsonl")
    sinks.write_jsonl(documents(spark, sf_dir), path)
    return sources.read_jsonl(spark, path, "doc_id long, text string, lang string, source string, n_chars long")


def chunk_roundtrip(spark, sf_dir):
    path = shared_path(spark, "chunks")
    sinks.write_chunks(_chunks(spark, sf_dir), path, CHUNKS)
    return sources.read_chunks(spark, path).groupBy("chunk", "line").agg(F.count(F.lit(1)).alias("n"))


def corpus_lines(spark, sf_dir):
    return wordstats.corpus_lines(documents(spark, sf_dir), "text", "doc_id")


def chunk_rewrite(spark, sf_dir):
    """Two chunks written anew, after a first writing with wrong texts there: the others stay, readers see the new set."""
    path = shared_path(spark, "chunks")
    chunks = _chunks(spark, sf_dir)
    wrong = F.when(F.col("chunk").isin(1, 4), F.lit("stale")).otherwise(F.col("text"))
    sinks.write_chunks(chunks.withColumn("text", wrong), path, CHUNKS)
    written = sinks.write_chunks(chunks, path, CHUNKS, rewrite=[1, 4])
    counted = sources.read_chunks(spark, path).groupBy("chunk", "line").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("written", F.col("chunk").isin(written))


def settings(spark, sf_dir):
    """The settings file, read back: a row per reserved token with how often the wrapped texts hold it."""
    path = shared_path(spark, "settings")
    sinks.write_settings(spark, path)
    stored = sources.read_jsonl(spark, path, sinks.SETTINGS_SCHEMA)
    tokens = stored.select("*", F.explode("added_tokens_decoder").alias("id", "token"))
    flags = ["lstrip", "normalized", "rstrip", "single_word", "special"]
    named = tokens.select(
        F.col("id").cast("int").alias("id"), "token.content", *[f"token.{f}" for f in flags], "bos_token", "eos_token", "unk_token", "pad_token",
        "add_bos_token", "add_prefix_space", "legacy", "tokenizer_class", F.col("model_max_length").cast("string").alias("model_max_length"),
        F.size("additional_special_tokens").alias("more"), F.md5("chat_template").alias("template"),
    )
    return named.join(special_tokens(spark, sf_dir).select("content", "n"), "content")


# order by place in the files


def _lines_backwards(spark, sf_dir):
    """All documents as JSON lines in several files whose order is that of descending ids."""
    path = shared_path(spark, "lines")
    docs = documents(spark, sf_dir)
    # as many files as the table has splits, so that a file does not grow with the table
    ordered = docs.repartitionByRange(max(CHUNKS, docs.rdd.getNumPartitions()), F.desc("doc_id")).sortWithinPartitions(F.desc("doc_id"))
    sinks.write_jsonl(ordered, path)
    return sources.read_jsonl(spark, path, "doc_id long, text string, lang string, source string, n_chars long")


def file_positions(spark, sf_dir):
    return places.with_position(_lines_backwards(spark, sf_dir)).select("doc_id", "position")


def file_head(spark, sf_dir):
    return places.head_by_place(_lines_backwards(spark, sf_dir), 50).select("doc_id", "text")


def file_chunks(spark, sf_dir):
    return places.chunks_by_place(_lines_backwards(spark, sf_dir), CHUNKS).select("doc_id", "chunk")


def file_chunks_compat(spark, sf_dir):
    return places.chunks_by_place(_lines_backwards(spark, sf_dir), CHUNKS, compat=True, percent=50).select("doc_id", "chunk")


def permuted_batches(spark, sf_dir):
    """Two epochs of the documents, each in an order of its own that no sort makes."""
    placed = batches.assign_batches_by_place(_lines_backwards(spark, sf_dir), epochs=EPOCHS)
    return placed.select("doc_id", "rank", "micro_batch", "step")


def step_rows(spark, sf_dir, sizes=CHECKED):
    """Pretraining rows stored by step, and read back from the second step on by two processes."""
    path = shared_path(spark, "steps")
    encoder = _encoder(spark, sf_dir, sizes)
    plans.build_step_rows(_lines_backwards(spark, sf_dir), "pretrain", encoder, path, keep=("doc_id",), steps_per_file=2)
    read = [steps.read_steps(spark, f"{path}/rows", 1, process=p, processes=2).withColumn("process", F.lit(p)) for p in range(2)]
    return _shown(read[0].unionByName(read[1]), "doc_id", "rank", "micro_batch", "step", "process")


def stream_steps(spark, sf_dir):
    """Two epochs stored by step and replayed as a stream, two steps to a micro batch."""
    path = shared_path(spark, "replay")
    placed = batches.assign_batches_by_place(_lines_backwards(spark, sf_dir), epochs=EPOCHS).select("doc_id", "rank")
    steps.write_steps(placed, f"{path}/rows", EPOCHS * documents(spark, sf_dir).count(), steps_per_file=2)
    replay.store_steps(spark, f"{path}/rows", f"{path}/out", f"{path}/progress", steps_per_batch=2)
    return spark.read.parquet(f"{path}/out").select("doc_id", "rank", "micro_batch", "step", "batch")


# projections


def drop_columns(spark, sf_dir):
    return columns.drop_columns(documents(spark, sf_dir), "source", "n_chars")


def instruct_schema(spark, sf_dir):
    return plans.instruct_union(alpaca_source(spark, sf_dir), orca_source(spark, sf_dir))


def title_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", columns.title_text(F.col("source"), F.col("text")).alias("text"))


def map_batches(spark, sf_dir):
    """Title and text joined by a user function on batches, the other columns removed."""

    def join(batch):
        return {"text": batch["source"].fillna("") + " " + batch["text"]}

    return columns.map_batches(documents(spark, sf_dir), join, "text string", remove=["lang", "source", "n_chars"])


def wrap_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", columns.wrap_text(F.col("text")).alias("text"))


def instruct_messages(spark, sf_dir):
    def shown(messages: Column) -> Column:
        return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")

    return instruct_source(spark, sf_dir).select(
        "conv_id", "turn",
        shown(chat.prompt_messages(F.col("instruct"), F.col("input"))).alias("prompt"),
        shown(chat.answer_messages(F.col("output"))).alias("answer"),
    )


def union_sources(spark, sf_dir):
    docs = documents(spark, sf_dir).select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text")
    items = table(spark, sf_dir, "benchmark").select("text", F.col("item_id").alias("id"), F.lit("benchmark").alias("origin"))
    return columns.union_sources(docs, items)


def rejected_rows(spark, sf_dir):
    rows = instruct_source(spark, sf_dir, answered=False)
    good, bad = columns.split_rejects(rows, columns.instruct_reject(F.col("instruct"), F.col("input"), F.col("output")))
    return (
        good.select("conv_id", "turn", F.lit("").alias("reject_reason"))
        .unionByName(bad.select("conv_id", "turn", "reject_reason"))
    )


# order, samples, splits


def _by_id(df: DataFrame) -> ranking.Order:
    return ranking.positional_order(df, "doc_id")


def _chunks(spark, sf_dir, compat=False):
    docs = documents(spark, sf_dir)
    return ranking.corpus_chunks(docs, CHUNKS, _by_id(docs), compat)


def shuffle_rank(spark, sf_dir):
    return ranking.with_rank(documents(spark, sf_dir).select("doc_id"), ranking.seeded_order("doc_id"))


def sample_per_subset(spark, sf_dir):
    rows = ranking.sample_per_subset(documents(spark, sf_dir), SAMPLE_ROWS, "lang", "doc_id", subsets=LANGUAGES)
    return rows.select("doc_id", "lang", "text")


def sample_per_subset_unlisted(spark, sf_dir):
    rows = ranking.sample_per_subset(documents(spark, sf_dir), SAMPLE_ROWS, "source", "doc_id")
    return rows.select("doc_id", "source", "text")


def split_exact(spark, sf_dir):
    return ranking.split_exact(documents(spark, sf_dir), 0.05, "doc_id").select("doc_id", "part")


def split_per_subset(spark, sf_dir):
    rows = ranking.split_exact(documents(spark, sf_dir), 0.1, "doc_id", by="lang", subsets=LANGUAGES)
    return rows.select("doc_id", "lang", "part")


def split_hash(spark, sf_dir):
    return ranking.split_hash(documents(spark, sf_dir), 0.05, "doc_id").select("doc_id", "part")


def head_fraction(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return ranking.head_fraction(docs, 50, _by_id(docs)).select("doc_id", "text")


def corpus_chunks(spark, sf_dir):
    return _chunks(spark, sf_dir).select("doc_id", "chunk")


def corpus_chunks_compat(spark, sf_dir):
    return _chunks(spark, sf_dir, compat=True).select("doc_id", "chunk")


def sample_repeated_keys(spark, sf_dir):
    """Samples by a key that repeats: exactly so many rows, counted by key."""
    docs = documents(spark, sf_dir).withColumn("size", F.floor(F.col("n_chars") / 100))
    rows = ranking.sample_per_subset(docs, SAMPLE_ROWS, "lang", "size", subsets=LANGUAGES)
    return rows.groupBy("lang", "size").agg(F.count(F.lit(1)).alias("n"))


def sample_repeated_keys_unlisted(spark, sf_dir):
    docs = documents(spark, sf_dir).withColumn("size", F.floor(F.col("n_chars") / 100))
    rows = ranking.sample_per_subset(docs, SAMPLE_ROWS // 10, "source", "size")
    return rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))


def chunks_repeated_keys(spark, sf_dir):
    """Chunks in the order of a column that repeats."""
    docs = documents(spark, sf_dir).withColumn("size", F.floor(F.col("n_chars") / 100))
    rows = ranking.corpus_chunks(docs, CHUNKS, ranking.positional_order(docs, "size"))
    return rows.groupBy("chunk", "size").agg(F.count(F.lit(1)).alias("n"))


def split_repeated_keys(spark, sf_dir):
    docs = documents(spark, sf_dir).withColumn("size", F.floor(F.col("n_chars") / 100))
    return ranking.split_exact(docs, 0.05, "size").groupBy("part", "size").agg(F.count(F.lit(1)).alias("n"))


def tokenizer_sample(spark, sf_dir):
    """A tenth of each language, in chunks by language, with the title in front."""
    docs = documents(spark, sf_dir).withColumnsRenamed({"doc_id": "id", "lang": "subset", "source": "title"}).withColumn("url", F.lit(""))
    rows = plans.tokenizer_sample(docs, LANGUAGES)
    return rows.select("subset", "text", "n_chars", "chunk")


def assign_batches(spark, sf_dir):
    return batches.assign_batches(documents(spark, sf_dir).select("doc_id"), "doc_id")


def collect_batches(spark, sf_dir):
    placed = batches.assign_batches(documents(spark, sf_dir).select("doc_id", "n_chars"), "doc_id")
    rows = batches.collect_batches(placed, "doc_id", "n_chars")
    return rows.select("step", "micro_batch", text_of(F.col("rows.doc_id")).alias("doc_ids"), text_of(F.col("rows.n_chars")).alias("sizes"))


def training_batches_max_steps(spark, sf_dir):
    return batches.assign_batches(documents(spark, sf_dir).select("doc_id"), "doc_id", max_steps=MAX_STEPS)


# tokenizer training


def pretokenize(spark, sf_dir):
    words = pretokens.pretokens(F.col("text"))
    return spread_documents(spark, sf_dir).select("doc_id", F.size(words).cast("long").alias("n"), F.array_join(words, "|").alias("words"))


def word_counts(spark, sf_dir):
    return wordstats.word_counts(wordstats.corpus_lines(spread_documents(spark, sf_dir)))


def byte_alphabet(spark, sf_dir):
    return spread_documents(spark, sf_dir).select(
        "doc_id", bytelevel.to_stand_ins(F.col("text")).alias("symbols"), text_of(bytelevel.byte_ids(F.col("text"))).alias("ids")
    )


def byte_counts(spark, sf_dir):
    counts = wordstats.symbol_counts(_words(spread_documents(spark, sf_dir)))
    alphabet = spark.createDataFrame(wordstats.byte_alphabet(), "byte int, stand_in string, id int")
    # 256 rows on the left side; the counts have at most as many
    return alphabet.join(counts, "id", "left").select("byte", "stand_in", "id", F.coalesce("n", F.lit(0)).alias("n"))


def pair_counts(spark, sf_dir):
    return wordstats.pair_counts(_words(spread_documents(spark, sf_dir)))


def bpe_merges(spark, sf_dir, sizes=CHECKED):
    return merges.merges_table(spark, _learned(spark, sf_dir, sizes))


def bpe_merges_small_bounds(spark, sf_dir, sizes=CHECKED):
    """Merges of words seen five times, with bounds so small that a round proves few merges."""
    words = _words(documents(spark, sf_dir))
    learned = merges.learn_merges(words, FIRST_MERGE_ID + sizes.learned, 5, *sizes.bounds)
    return merges.merges_table(spark, learned)


def vocab(spark, sf_dir, sizes=CHECKED):
    return vocabulary.vocab_table(spark, _learned(spark, sf_dir, sizes)).select("id", "token", "kind", F.hex("bytes").alias("bytes"))


def vocab_export(spark, sf_dir, sizes=CHECKED):
    """Saved tables, read again: vocabulary with the merge that made each token."""
    path = shared_path(spark, "vocab")
    learned = _learned(spark, sf_dir, sizes)
    sinks.write_table(vocabulary.vocab_table(spark, learned), f"{path}/vocab")
    sinks.write_table(merges.merges_table(spark, learned), f"{path}/merges")
    made = spark.read.parquet(f"{path}/merges").select(F.col("new_id").alias("id"), "rank", "left", "right", "count")
    return spark.read.parquet(f"{path}/vocab").select("id", "token", "kind").join(made, "id", "left")


def vocab_import(spark, sf_dir, sizes=CHECKED):
    path = shared_path(spark, "vocab-json")
    sinks.write_vocab_json(vocabulary.vocab_table(spark, _learned(spark, sf_dir, sizes)), path)
    return sources.read_vocab_json(spark, path)


def vocab_merge(spark, sf_dir, sizes=CHECKED):
    base = vocabulary.vocab_table(spark, _learned(spark, sf_dir, sizes, base=True))
    return vocabulary.extend_vocab(base, vocabulary.vocab_table(spark, _learned(spark, sf_dir, sizes))).drop("bytes")


def vocab_merge_sized(spark, sf_dir, sizes=CHECKED):
    """The joint vocabulary ends at its size."""
    base = vocabulary.vocab_table(spark, _learned(spark, sf_dir, sizes, base=True))
    new = vocabulary.vocab_table(spark, _learned(spark, sf_dir, sizes))
    return vocabulary.extend_vocab(base, new, sizes.joint).drop("bytes")


def vocab_recovered(spark, sf_dir, sizes=CHECKED):
    """The pair that makes each token, from tokens and ids alone."""
    return recovery.recover_merges(_supplied(spark, sf_dir, sizes)[0]).select("id", "token", "left", "right")


def encode_base(spark, sf_dir, sizes=CHECKED):
    """Ids of every document under the supplied vocabulary."""
    ids = _supplied(spark, sf_dir, sizes)[1].encoder(spark).encode(F.col("text"))
    return spread_documents(spark, sf_dir).select("doc_id", text_of(ids).alias("ids"))


def bpe_merges_after_base(spark, sf_dir, sizes=CHECKED):
    return merges.merges_table(spark, _learned_after(spark, sf_dir, sizes))


def vocab_after_base(spark, sf_dir, sizes=CHECKED):
    known, base = _supplied(spark, sf_dir, sizes)
    return recovery.joint_vocab(known, base, _learned_after(spark, sf_dir, sizes)).drop("bytes")


def encode_after_base(spark, sf_dir, sizes=CHECKED):
    """Ids of every document under the supplied vocabulary and what was learned after it."""
    base = _supplied(spark, sf_dir, sizes)[1]
    ids = base.encoder(spark, _learned_after(spark, sf_dir, sizes)).encode(F.col("text"))
    return spread_documents(spark, sf_dir).select("doc_id", text_of(ids).alias("ids"))


def special_tokens(spark, sf_dir):
    """The reserved tokens and how often each occurs in the wrapped texts."""
    pieces = documents(spark, sf_dir).select(F.explode(pretokens.split_specials(columns.wrap_text(F.col("text")))).alias("content"))
    found = pieces.filter(F.col("content").isin(SPECIAL_TOKENS)).groupBy("content").agg(F.count(F.lit(1)).alias("n"))
    return vocabulary.special_tokens(spark).join(found, "content", "left").select(
        "id", "content", "special", F.coalesce("n", F.lit(0)).alias("n")
    )


# tokens


def encode(spark, sf_dir, sizes=CHECKED):
    ids = _encoder(spark, sf_dir, sizes).encode(F.col("text"))
    return spread_documents(spark, sf_dir).select("doc_id", text_of(ids).alias("ids"))


def special_split(spark, sf_dir):
    marked = F.concat(F.lit("<s>"), "source", F.lit("</s>"), "text", F.lit("<mask>"), "lang")
    return spread_documents(spark, sf_dir).select("doc_id", F.array_join(pretokens.encode_words(marked), "|").alias("words"))


def add_bos_eos(spark, sf_dir):
    ids = sequences.add_bos_eos(bytelevel.byte_ids(F.col("text")))
    return spread_documents(spark, sf_dir).select("doc_id", text_of(ids).alias("ids"))


def decode(spark, sf_dir, sizes=CHECKED):
    tokens = vocabulary.token_texts(_learned(spark, sf_dir, sizes))
    coded = spread_documents(spark, sf_dir).select("doc_id", _encoder(spark, sf_dir, sizes).encode(F.col("text")).alias("ids"))
    return coded.select(
        "doc_id",
        decode_ids(F.col("ids"), tokens).alias("text"),
        decode_ids(F.col("ids"), tokens, skip=range(len(SPECIAL_TOKENS))).alias("plain"),
    )


def roundtrip(spark, sf_dir, sizes=CHECKED):
    tokens = vocabulary.token_texts(_learned(spark, sf_dir, sizes))
    summary = training_rows.round_trip(spread_documents(spark, sf_dir), _encoder(spark, sf_dir, sizes), tokens, "lang")
    return summary.withColumn("chars_per_token", F.round("chars_per_token", 6))


def in_scripts(text: Column) -> Column:
    """Letters a to z of every text in three other scripts, one after the other."""
    return F.concat(*[F.translate(F.lower(text), "abcdefghijklmnopqrstuvwxyz", letters) for letters in (CYRILLIC, ARABIC, HAN)])


def roundtrip_scripts(spark, sf_dir, sizes=CHECKED):
    docs = spread_documents(spark, sf_dir).withColumn("text", in_scripts(F.col("text")))
    tokens = vocabulary.token_texts(_learned(spark, sf_dir, sizes))
    summary = training_rows.round_trip(docs, _encoder(spark, sf_dir, sizes), tokens, "lang")
    return summary.withColumn("chars_per_token", F.round("chars_per_token", 6))


# chat


def chat_turns(spark, sf_dir):
    return chat_ops.rendered_turns(table(spark, sf_dir, "conversations"))


def chat_render(spark, sf_dir):
    return chat_ops.render_conversations(table(spark, sf_dir, "conversations"), SEGMENT_TURNS)


def chat_render_rows(spark, sf_dir):
    prompt = chat.prompt_messages(F.col("instruct"), F.col("input"))
    return instruct_source(spark, sf_dir).select(
        "conv_id", "turn", chat.render_messages(prompt).alias("prompt"),
        chat.render_messages(chat.answer_messages(F.col("output"))).alias("answer"),
    )


def chat_encode(spark, sf_dir, sizes=CHECKED):
    rows = training_rows.chat_ids(instruct_source(spark, sf_dir), _encoder(spark, sf_dir, sizes))
    return rows.select("conv_id", "turn", text_of(F.col("prompt")).alias("prompt"), text_of(F.col("answer")).alias("answer"))


# sequences


def pad_truncate(spark, sf_dir):
    ids = spread_documents(spark, sf_dir).select("doc_id", bytelevel.byte_ids(F.col("text")).alias("ids"))
    return ids.select("doc_id", text_of(sequences.pad_truncate(F.col("ids"), MAX_SEQ_LEN)).alias("ids"))


def _pretrain(spark, sf_dir, sizes, compat=False):
    return training_rows.pretrain_rows(spread_documents(spark, sf_dir), _encoder(spark, sf_dir, sizes), compat=compat, keep=("doc_id",))


def _instruct(spark, sf_dir, sizes, compat=False):
    return training_rows.instruct_rows(instruct_source(spark, sf_dir), _encoder(spark, sf_dir, sizes), compat=compat, keep=("conv_id", "turn"))


def _shown(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, *[text_of(F.col(c)).alias(c) for c in df.columns if c not in keep])


def pretrain_rows(spark, sf_dir, sizes=CHECKED):
    return _shown(_pretrain(spark, sf_dir, sizes), "doc_id")


def pretrain_rows_compat(spark, sf_dir, sizes=CHECKED):
    return _shown(_pretrain(spark, sf_dir, sizes, compat=True), "doc_id")


def instruct_labels(spark, sf_dir):
    rows = instruct_source(spark, sf_dir).select(
        "conv_id", "turn", bytelevel.byte_ids(F.col("input")).alias("p"), bytelevel.byte_ids(F.col("output")).alias("a")
    )
    return rows.select("conv_id", "turn", text_of(sequences.mask_prompt(F.col("p"), F.col("a"))).alias("labels"))


def instruct_rows(spark, sf_dir, sizes=CHECKED):
    return _shown(_instruct(spark, sf_dir, sizes), "conv_id", "turn")


def instruct_rows_compat(spark, sf_dir, sizes=CHECKED):
    return _shown(_instruct(spark, sf_dir, sizes, compat=True), "conv_id", "turn")


def supervised_tokens(spark, sf_dir, sizes=CHECKED):
    docs = spread_documents(spark, sf_dir)
    rows = training_rows.pretrain_rows(docs, _encoder(spark, sf_dir, sizes), keep=("lang",))
    return training_rows.supervised_tokens(rows, "lang").withColumn("mean_tokens", F.round("mean_tokens", 6))


def id_domain(spark, sf_dir, sizes=CHECKED):
    rows = _pretrain(spark, sf_dir, sizes, compat=True)
    good, bad = training_rows.split_domain(rows, FIRST_MERGE_ID + sizes.learned)
    return good.select("doc_id", F.lit(True).alias("usable")).unionByName(bad.select("doc_id", F.lit(False).alias("usable")))


def id_domain_small(spark, sf_dir, sizes=CHECKED):
    """A vocabulary smaller than the tokenizer's: its highest ids are out of the domain."""
    held = len(vocabulary.token_texts(_learned(spark, sf_dir, sizes)))
    good, bad = training_rows.split_domain(_pretrain(spark, sf_dir, sizes), held - 2)
    return good.select("doc_id", F.lit(True).alias("usable")).unionByName(bad.select("doc_id", F.lit(False).alias("usable")))


def training_batches(spark, sf_dir, sizes=CHECKED):
    """Pretraining rows with their place in the training order, assigned before encoding."""
    placed = batches.assign_batches(documents(spark, sf_dir), "doc_id")
    keep = ("doc_id", "rank", "micro_batch", "step")
    return _shown(training_rows.pretrain_rows(placed, _encoder(spark, sf_dir, sizes), keep=keep), *keep)


# streams


def stream_pretrain(spark, sf_dir, sizes=CHECKED):
    path = shared_path(spark, "stream-pretrain")
    sinks.write_jsonl(documents(spark, sf_dir).select("doc_id", "text"), f"{path}/in")
    streaming.stream_pretrain(
        spark, f"{path}/in", f"{path}/out", f"{path}/progress", _encoder(spark, sf_dir, sizes), keep_schema="doc_id long", keep=("doc_id",)
    )
    return _shown(spark.read.parquet(f"{path}/out"), "doc_id")


def stream_instruct(spark, sf_dir, sizes=CHECKED):
    path = shared_path(spark, "stream-instruct")
    sinks.write_jsonl(instruct_source(spark, sf_dir), f"{path}/in")
    streaming.stream_instruct(
        spark, f"{path}/in", f"{path}/out", f"{path}/progress", _encoder(spark, sf_dir, sizes),
        keep_schema="conv_id long, turn long", keep=("conv_id", "turn"),
    )
    return _shown(spark.read.parquet(f"{path}/out"), "conv_id", "turn")


def stream_rejects(spark, sf_dir, sizes=CHECKED):
    """Texts set to null by rule: the stream keeps them apart, the others become rows."""
    path = shared_path(spark, "stream-rejects")
    text = F.when(F.col("doc_id") % 7 != 0, F.col("text"))
    sinks.write_jsonl(documents(spark, sf_dir).select("doc_id", text.alias("text")), f"{path}/in")
    streaming.stream_pretrain(
        spark, f"{path}/in", f"{path}/out", f"{path}/progress", _encoder(spark, sf_dir, sizes), keep_schema="doc_id long", keep=("doc_id",),
        rejects=f"{path}/bad",
    )
    good = spark.read.parquet(f"{path}/out").select("doc_id", F.lit("").alias("reject_reason"))
    return good.unionByName(spark.read.parquet(f"{path}/bad").select("doc_id", "reject_reason"))


def sampled_languages(spark, sf_dir):
    """Flagship: an equal seeded sample per language, wrapped, and counted."""
    rows = sample_per_subset(spark, sf_dir).withColumn("text", columns.wrap_text(F.col("text")))
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text").cast("long")).alias("chars"))


QUERIES = {
    f.__name__: f
    for f in (
        sampled_languages, scan_subsets, scan_instruct, jsonl_roundtrip, chunk_roundtrip, corpus_lines, drop_columns,
        instruct_schema, title_text, map_batches, wrap_text, instruct_messages, union_sources, rejected_rows, shuffle_rank,
        sample_per_subset, sample_per_subset_unlisted, split_exact, split_per_subset, split_hash, head_fraction,
        corpus_chunks, corpus_chunks_compat, assign_batches, collect_batches, pretokenize, word_counts, byte_alphabet,
        byte_counts, pair_counts, bpe_merges, vocab, vocab_export, vocab_import, vocab_merge, special_tokens, encode,
        special_split, add_bos_eos, decode, roundtrip, chat_render, chat_render_rows, chat_encode, pad_truncate,
        pretrain_rows, pretrain_rows_compat, instruct_labels, instruct_rows, instruct_rows_compat, supervised_tokens,
        id_domain, training_batches, stream_pretrain, stream_instruct, chunk_rewrite, settings, sample_repeated_keys,
        sample_repeated_keys_unlisted, chunks_repeated_keys, split_repeated_keys, tokenizer_sample, training_batches_max_steps,
        bpe_merges_small_bounds, vocab_merge_sized, roundtrip_scripts, chat_turns, id_domain_small, stream_rejects,
        vocab_recovered, encode_base, bpe_merges_after_base, vocab_after_base, encode_after_base, file_positions, file_head, file_chunks,
        file_chunks_compat, permuted_batches, step_rows, stream_steps,
    )
} | {f"{f.__name__}_{HUNDREDS}": partial(f, sizes=RECURSIVE) for f in (bpe_merges, encode, pretrain_rows)}

# The same at the published vocabulary size, as far as the table has pairs seen often enough. The SQL cannot follow so many
# merges; tests compare these with a plain trainer.
PUBLISHED_QUERIES = {
    f"{f.__name__}_published": partial(f, sizes=PUBLISHED)
    for f in (
        bpe_merges, bpe_merges_small_bounds, vocab, vocab_export, vocab_import, vocab_merge, vocab_merge_sized, encode, decode,
        roundtrip, roundtrip_scripts, chat_encode, pretrain_rows, pretrain_rows_compat, instruct_rows, instruct_rows_compat,
        supervised_tokens, id_domain, id_domain_small, training_batches, stream_pretrain, stream_instruct, stream_rejects,
        vocab_recovered, encode_base, bpe_merges_after_base, vocab_after_base, encode_after_base, step_rows,
    )
}
