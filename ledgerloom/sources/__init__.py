"""Readers of filings, documents and regulators' files, as tables."""
