"""Spark jobs for the life of a tabular classification problem.

Cleaning, validation, profiling, features, fitting, scoring, run and model
tables, monitoring and drift, all as DataFrame, ``pyspark.ml`` and Structured
Streaming code.
"""
