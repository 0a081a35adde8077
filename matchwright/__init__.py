"""Provider analytics on Spark: clean, describe, group, match and report."""

__version__ = "0.1.0"
