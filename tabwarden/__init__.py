"""Data-side operators of a tabular model lifecycle, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
