"""Labelled-text profiling and classification as Spark DataFrame jobs."""
