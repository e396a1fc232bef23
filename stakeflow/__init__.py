"""Stakeflow: validator and staking analytics as PySpark DataFrame jobs."""

__version__ = "0.1.0"
