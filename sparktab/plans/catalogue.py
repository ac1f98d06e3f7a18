"""Importing the query modules fills the catalogue."""

from sparktab.plans import charting, corners, explaining, further, growing, modelling, moving, profiling, training  # noqa: F401
from sparktab.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
