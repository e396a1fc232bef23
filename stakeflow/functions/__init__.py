"""Column expressions shared by the pipelines."""
