"""Spark-native preparation of language-model pretraining corpora."""
