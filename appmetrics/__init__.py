"""Analytics over app-marketplace listings, written as PySpark DataFrame jobs."""

__version__ = "0.1.0"
