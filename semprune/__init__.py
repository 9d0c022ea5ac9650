"""Semantic de-duplication and pruning of text corpora on Spark DataFrames."""
