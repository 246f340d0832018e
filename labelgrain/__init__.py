"""Labelled-text preparation, exploration, scoring and evaluation on Spark.

Every operator takes DataFrames and returns a DataFrame; the work is declared
with built-in expressions and left to Catalyst, with no Python UDFs.
"""
