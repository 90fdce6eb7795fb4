"""Tidemark: guarded table refreshes, content scans and corpus operators as Spark DataFrame jobs."""
