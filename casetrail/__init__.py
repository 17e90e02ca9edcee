"""Permit event histories on Spark: staging joins, rule sets and event records as DataFrame plans."""
