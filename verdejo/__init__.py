"""Verdejo: a medallion warehouse for retail extracts, built on Spark DataFrames."""

__version__ = "0.1.0"
