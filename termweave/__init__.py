"""Batch analytics over text, graphs and token sets, written as Spark DataFrame operators."""
