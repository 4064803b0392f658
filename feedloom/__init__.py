"""Feedloom: content-stream and logistics analytics written as PySpark DataFrame jobs."""
