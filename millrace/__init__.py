"""Batch and stream ETL on Spark: rules, de-duplication, totals, word counts, loads, events."""

from millrace.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
