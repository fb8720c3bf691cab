"""Cleaning of large ticker panels on Spark."""
