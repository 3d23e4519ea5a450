"""Writers."""

from __future__ import annotations

import json
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.constants import BOS, CHAT_TEMPLATE, EOS, SPECIAL_TOKENS
from tokenloom.sinks import manifest


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def _chunk_set(spark: SparkSession, path: str, chunks: int, tag: str) -> tuple[int, dict[str, str]]:
    """Newest version, and the folder of each chunk in it that was written with this number of chunks and ``tag``."""
    version, content = manifest.current(spark, path)
    same = content.get("chunks") == chunks and content.get("tag") == tag
    return version, content["folders"] if same else {}


def existing_chunks(spark: SparkSession, path: str, chunks: int, tag: str = "") -> list[int]:
    """Chunk numbers that an earlier call with the same number of chunks and ``tag`` wrote completely."""
    return sorted(int(i) for i in _chunk_set(spark, path, chunks, tag)[1])


def write_chunks(
    df: DataFrame, path: str, chunks: int, text: str = "text", chunk: str = "chunk", tag: str = "", rewrite: Sequence[int] = ()
) -> list[int]:
    """Text files per chunk, one document and a line break each; chunks completed earlier stay as they are, except ``rewrite``.

    One pass writes all missing chunks into a folder of their own. The set of chunks then changes at once, by a new manifest that
    readers follow: until it is there they read what was there before, also if this call fails or is killed. A set with another
    number of chunks or ``tag`` (such as the seed of the order) is replaced whole. Returns the numbers written. Folders that
    no set names any more stay until ``manifest.remove_unused`` is called.
    """
    spark = df.sparkSession
    version, folders = _chunk_set(spark, path, chunks, tag)
    missing = [i for i in range(chunks) if str(i) not in folders or i in rewrite]
    if missing:
        folder = manifest.new_folder()
        rows = df.filter(F.col(chunk).isin(missing)).select(F.col(chunk).alias("chunk"), F.col(text).alias("value"))
        rows.write.partitionBy("chunk").option("lineSep", "\n").text(f"{path.rstrip('/')}/{folder}")
        manifest.commit(spark, path, version + 1, {"chunks": chunks, "tag": tag, "folders": {**folders, **{str(i): folder for i in missing}}})
    return missing


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def as_int64(rows: DataFrame) -> DataFrame:
    """Token arrays as 64-bit integers, the type that training frameworks expect; other columns unchanged."""
    wide = {f.name: F.col(f"`{f.name}`").cast("array<bigint>") for f in rows.schema if f.dataType.simpleString() == "array<int>"}
    return rows.withColumns(wide) if wide else rows


def _vocab_json() -> Column:
    """Token to id as JSON text, in id order; at most ``vocab_size`` entries."""
    entries = F.array_sort(F.collect_list(F.struct("id", "token")))
    pairs = F.transform(entries, lambda e: F.struct(e["token"], e["id"]))
    return F.to_json(F.map_from_entries(pairs))


def _merge_names(merges: DataFrame, vocab: DataFrame) -> DataFrame:
    """Merges with the texts ``l`` and ``r`` of their parts."""
    names = vocab.select("id", "token")
    left = names.select(F.col("id").alias("left"), F.col("token").alias("l"))
    right = names.select(F.col("id").alias("right"), F.col("token").alias("r"))
    return merges.join(left, "left").join(right, "right").select("rank", "l", "r")


def write_vocab_json(vocab: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Token to id as one JSON map."""
    vocab.agg(_vocab_json().alias("value")).coalesce(1).write.mode(mode).text(path)


def write_merges_text(merges: DataFrame, vocab: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Merge list as text, one pair of tokens per line in rank order; at most ``vocab_size`` lines."""
    lines = _merge_names(merges, vocab).select("rank", F.concat_ws(" ", "l", "r").alias("value"))
    head = lines.sparkSession.createDataFrame([(-1, "#version: 0.2")], "rank int, value string")
    head.unionByName(lines).coalesce(1).sortWithinPartitions("rank").select("value").write.mode(mode).text(path)


def write_tokenizer_json(merges: DataFrame, vocab: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The whole tokenizer as one JSON document in the common fast-tokenizer format."""
    byte_level = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}
    begin, end = SPECIAL_TOKENS[BOS], SPECIAL_TOKENS[EOS]
    ids = {r.token: r.id for r in vocab.filter(F.col("kind") == "special").select("token", "id").collect()}
    flags = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
    document = {
        "version": "1.0",
        "truncation": None,
        "padding": None,
        "added_tokens": [{"id": ids[t], "content": t, **flags} for t in sorted(SPECIAL_TOKENS, key=ids.get)],
        "normalizer": None,
        "pre_tokenizer": byte_level,
        "post_processor": {
            "type": "TemplateProcessing",
            "single": [
                {"SpecialToken": {"id": begin, "type_id": 0}},
                {"Sequence": {"id": "A", "type_id": 0}},
                {"SpecialToken": {"id": end, "type_id": 0}},
            ],
            "pair": [{"Sequence": {"id": "A", "type_id": 0}}, {"Sequence": {"id": "B", "type_id": 1}}],
            "special_tokens": {t: {"id": t, "ids": [ids[t]], "tokens": [t]} for t in (begin, end)},
        },
        "decoder": byte_level,
        "model": {
            "type": "BPE",
            "dropout": None,
            "unk_token": None,
            "continuing_subword_prefix": None,
            "end_of_word_suffix": None,
            "fuse_unk": False,
            "byte_fallback": False,
            "ignore_merges": False,
        },
    }
    # the model object is last and stays open for its two large members
    opening = json.dumps(document, ensure_ascii=False)[: -len("}}")]
    ordered = F.array_sort(F.collect_list(F.struct("rank", "l", "r")))
    pairs = _merge_names(merges, vocab).agg(F.to_json(F.transform(ordered, lambda m: F.array(m["l"], m["r"]))))
    tokens = vocab.agg(_vocab_json())
    whole = F.concat(F.lit(opening), F.lit(', "vocab": '), tokens.scalar(), F.lit(', "merges": '), pairs.scalar(), F.lit("}}"))
    vocab.sparkSession.range(1).select(whole.alias("value")).coalesce(1).write.mode(mode).text(path)


_TOKEN = "struct<content:string,lstrip:boolean,normalized:boolean,rstrip:boolean,single_word:boolean,special:boolean>"
SETTINGS_SCHEMA = (
    "add_bos_token boolean, add_eos_token boolean, add_prefix_space boolean, "
    f"added_tokens_decoder map<string,{_TOKEN}>, additional_special_tokens array<string>, bos_token string, "
    "clean_up_tokenization_spaces boolean, eos_token string, legacy boolean, model_max_length decimal(38,0), "
    "pad_token string, sp_model_kwargs map<string,string>, spaces_between_special_tokens boolean, "
    "tokenizer_class string, unk_token string, use_default_system_prompt boolean, chat_template string"
)


def settings_table(spark: SparkSession) -> DataFrame:
    """One row with the tokenizer settings."""
    # Fixed values of the settings file.
    row = {
        "add_bos_token": False,
        "add_eos_token": False,
        "add_prefix_space": True,
        "added_tokens_decoder": {
            str(i): (content, False, False, False, False, True) for i, content in enumerate(SPECIAL_TOKENS)
        },
        "additional_special_tokens": [],
        "bos_token": "<s>",
        "clean_up_tokenization_spaces": False,
        "eos_token": "</s>",
        "legacy": True,
        "model_max_length": Decimal("1000000000000000019884624838656"),
        "pad_token": None,
        "sp_model_kwargs": {},
        "spaces_between_special_tokens": False,
        "tokenizer_class": "PreTrainedTokenizerFast",
        "unk_token": "<unk>",
        "use_default_system_prompt": False,
        "chat_template": CHAT_TEMPLATE,
    }
    return spark.createDataFrame([tuple(row.values())], SETTINGS_SCHEMA)


def write_settings(spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
    settings_table(spark).coalesce(1).write.mode(mode).option("ignoreNullFields", "false").json(path)
