"""Ledgermill: analytics over structured company filings, expressed as Spark DataFrame jobs."""

__version__ = "0.1.0"
