"""Spark-native analytics for genomic intervals, read pipelines and evaluation."""
