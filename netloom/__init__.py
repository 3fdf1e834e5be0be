"""Spark jobs that turn document collections and reference tables into a scored entity network."""

__version__ = "0.1.0"
