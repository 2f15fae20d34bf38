"""Scans and sinks: CSV dialects, multi-format reads, paged JSON, landing areas,
the named-source registry and versioned tables."""

from lakevault.sources.versioned import VersionedTable

__all__ = ["VersionedTable"]
