"""Runs in ordered event data, and the fixture warehouse around them, on Spark."""

__version__ = "0.1.0"
