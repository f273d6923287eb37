"""spendlens: marketing cost views as Spark DataFrame jobs."""

__version__ = "0.1.0"
