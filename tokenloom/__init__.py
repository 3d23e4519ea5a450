"""Corpus, tokenizer and training-row jobs on Spark."""
