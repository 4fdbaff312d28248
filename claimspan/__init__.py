"""claimspan: healthcare claims analytics as PySpark DataFrame functions."""

__version__ = "0.1.0"
