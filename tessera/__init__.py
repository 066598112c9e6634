"""Spark-native record linkage and profiling."""
