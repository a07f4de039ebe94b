"""barflow: daily market-bar data operations as PySpark DataFrame plans."""

__version__ = "0.1.0"
