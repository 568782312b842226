"""Spark-native analytics over business query results, and training-data operators in ``tallywell.llm``."""
