"""Rule checks, reconciliation and period reporting of regulatory credit data on Spark."""

__version__ = "0.1.0"
