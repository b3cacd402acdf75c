"""Retail and cold-chain analytics on Spark DataFrames."""
