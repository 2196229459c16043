"""Scalar column functions. All are built-in Spark expressions (no UDFs)."""

from nimbus.functions import advice, exact, geo, text, timefn, units

__all__ = ["advice", "exact", "geo", "text", "timefn", "units"]
