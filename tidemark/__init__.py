"""Snapshot analytics on Spark.

Measurements sampled on a schedule that can never be sampled again: loads that
are safe to rerun, dense facts that keep the gaps, and a ledger that names them.
"""
