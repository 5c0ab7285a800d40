"""Spark operators for wide form submissions, long data points and incremental publishing."""
