"""Customer-retention analytics as plain Spark DataFrame jobs.

Every operator takes DataFrames and returns a DataFrame; nothing is kept
between calls.  See the README for the map from question to function.
"""
