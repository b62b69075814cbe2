"""Spark-native record linkage: text views, blocking joins, pair features, decisions and evaluation as DataFrame operators."""
