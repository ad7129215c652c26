"""Spark-native pipelines for climate series, sky catalogues and wide-table profiling."""

__version__ = "0.1.0"
