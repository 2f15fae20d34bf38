"""Lakehouse and Data Vault operators composed from public DataFrame APIs."""

__version__ = "0.1.0"
