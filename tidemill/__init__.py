"""Analytics on tables, streams, text and vectors, written as plain Spark DataFrame functions."""
