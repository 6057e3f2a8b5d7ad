"""Vintara: one clean table out of many yearly releases of the same dataset.

Everything is a function from DataFrames to DataFrames (or Columns to Columns),
to be chained with ``DataFrame.transform``.
"""

__version__ = "0.1.0"
