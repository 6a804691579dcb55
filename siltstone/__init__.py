"""Spark-native record governance and training-data preparation.

The package holds the record model (``plans``), column-level functions
(``functions``), distributed operators (``operators``), readers and writers
(``sources``) and Structured Streaming wrappers (``streaming``).
"""

__version__ = "0.1.0"
