"""pagelode: a PySpark engine for technical-document tables and training-data preparation."""

__version__ = "0.1.0"
