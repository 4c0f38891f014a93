"""Curvelake: calibrated estimates from event history and multi-source quotes, on Spark."""

__version__ = "0.1.0"
