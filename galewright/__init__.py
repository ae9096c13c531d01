"""Galewright: feature derivation, scoring and model monitoring as Spark DataFrame jobs."""

__version__ = "0.1.0"
