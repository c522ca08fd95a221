"""Plumbline: data-quality, reconciliation and KPI operators on Spark DataFrames."""

__version__ = "0.1.0"
