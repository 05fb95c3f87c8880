"""Readers for bars, results, documents, tick tables and live records."""
