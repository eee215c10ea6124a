"""Retrieval evaluation, corpus comparison and text classification on Spark DataFrames."""
