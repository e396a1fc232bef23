"""Staking pipelines: DataFrames in, one published table out."""
