"""Coverloom: planning and scoring of group assembly on Spark DataFrames."""

__version__ = "0.1.0"
