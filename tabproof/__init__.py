"""Contract checks, leakage-safe preparation, baselines and evaluation on Spark tables."""

__version__ = "0.1.0"
