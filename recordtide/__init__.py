"""Incremental relational cache of nested business records, built on Spark DataFrames."""
