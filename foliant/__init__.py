"""foliant: document-evidence processing on Spark DataFrames."""

__version__ = "0.1.0"
