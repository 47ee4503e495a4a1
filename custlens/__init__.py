"""Customer and marketing analytics operators for Spark DataFrames."""

__version__ = "0.1.0"
