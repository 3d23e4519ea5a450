"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from catalog import queries as catalog
from catalog.inputs import documents, instruct_source, spread_documents, table
from tokenloom import plans, sinks, sources
from tokenloom.constants import FIRST_MERGE_ID
from tokenloom.functions.codec import Encoder
from tokenloom.operators import merges, ranking, training_rows, vocabulary, wordstats
from tokenloom.session import local_session, shared_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
VOCAB_SIZE = 32000
# Vocabulary learned with bounds a hundred times smaller, as if words were that much more diverse.
SMALL_VOCAB = 1000


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, memory="12g", partitions=int(CPUS) if CPUS.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    docs = documents(spark, SF_DIR)
    rows = docs.count()
    turns = instruct_source(spark, SF_DIR).count()
    run(spread_documents(spark, SF_DIR))
    times: dict[str, float] = {}

    def timed(name, action):
        began = time.perf_counter()
        result = action()
        times[name] = round(time.perf_counter() - began, 3)
        return result

    out = shared_path(spark, "bench")
    for name in (
        "scan_subsets", "sample_per_subset", "split_exact", "split_per_subset", "split_hash", "shuffle_rank", "head_fraction",
        "corpus_chunks", "assign_batches", "union_sources", "chat_render", "pretokenize", "word_counts", "pair_counts",
        "byte_alphabet", "special_split",
    ):
        timed(name, lambda: run(catalog.QUERIES[name](spark, SF_DIR)))
    timed("shuffle_rows", lambda: run(ranking.shuffle_rows(docs, "doc_id")))
    timed("write_chunks", lambda: sinks.write_chunks(plans.tokenizer_corpus(docs, "doc_id"), f"{out}/corpus", 6))
    words = wordstats.word_counts(sources.read_chunks(spark, f"{out}/corpus"))
    symbols = wordstats.symbol_words(words)
    rounds: dict[str, list[int]] = {"learn_merges": [], "learn_merges_small_bounds": []}
    learned = timed("learn_merges", lambda: merges.learn_merges(symbols, VOCAB_SIZE, 5, rounds=rounds["learn_merges"]))
    bounds = [max(n // 100, 2) for n in (merges.FIRST_PAIRS, merges.MOST_RUNS, merges.MOST_SYMBOLS)]
    small = rounds["learn_merges_small_bounds"]
    timed("learn_merges_small_bounds", lambda: merges.learn_merges(symbols, SMALL_VOCAB, 5, *bounds, rounds=small))
    encoder = Encoder(spark, learned)
    tokens = vocabulary.token_texts(learned)
    heavy = spread_documents(spark, SF_DIR)
    timed("encode", lambda: run(heavy.select(encoder.encode(F.col("text")))))
    timed("roundtrip", lambda: run(training_rows.round_trip(heavy, encoder, tokens, "lang")))
    timed("pretrain_rows", lambda: run(training_rows.pretrain_rows(heavy, encoder)))
    timed("instruct_rows", lambda: run(training_rows.instruct_rows(instruct_source(spark, SF_DIR), encoder)))
    timed("training_job", lambda: plans.build_training_rows(docs, "pretrain", encoder, f"{out}/rows", "doc_id"))

    words_seen = docs.select(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).first().n
    per_second = {
        "sample_rows": rows / times["sample_per_subset"],
        "split_rows": rows / times["split_exact"],
        "chunk_rows": rows / times["corpus_chunks"],
        "pretokenized_words": words_seen / times["pretokenize"],
        "merges": (len(learned)) / times["learn_merges"],
        "encoded_documents": rows / times["encode"],
        "pretrain_rows": rows / times["pretrain_rows"],
        "instruct_rows": turns / times["instruct_rows"],
    }
    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "per_second": {k: round(v, 1) for k, v in per_second.items()},
                "merges": len(learned),
                "rounds": {name: len(r) for name, r in rounds.items()},
                "seconds_per_round": {name: round(times[name] / max(len(r), 1), 2) for name, r in rounds.items()},
                "vocab_size": FIRST_MERGE_ID + len(learned),
                "turns": table(spark, SF_DIR, "conversations").count(),
                "sf": float(SF_DIR.rstrip("/").rsplit("sf", 1)[-1]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
