"""Signal integration and interest analytics on PySpark DataFrames."""

from signalstar.plans.star import Star

__all__ = ["Star"]
