"""Transcript analytics on Spark: relational, text, search and incremental operators over DataFrames."""
