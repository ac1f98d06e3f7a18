"""Tabular profiling, cleaning, classification and explanation on Spark DataFrames."""

from sparktab.spec import TableSpec, infer_spec

__all__ = ["TableSpec", "infer_spec"]
