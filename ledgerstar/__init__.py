"""Spark-native jobs that turn flat transaction files into a tested star schema."""
