"""Registry measurement on Spark: from raw logs and fetched documents to published figures."""

__version__ = "0.1.0"
