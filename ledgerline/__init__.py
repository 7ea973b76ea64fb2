"""Trustworthy transaction tables on Spark."""
