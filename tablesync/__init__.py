"""Snapshot, diff, merge, rewrite and check tables and content trees with Spark."""
