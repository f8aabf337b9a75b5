"""Earthquake-feed analytics as reusable PySpark DataFrame transforms."""
