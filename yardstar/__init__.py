"""yardstar: a PySpark warehouse for rental companies that share parking yards."""

__version__ = "0.1.0"
