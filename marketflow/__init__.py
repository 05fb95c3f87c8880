"""Batch and streaming analytics over price bars, written for Spark."""
