"""Batch analytics operators for multi-channel consumer-goods sales, on Spark DataFrames."""
