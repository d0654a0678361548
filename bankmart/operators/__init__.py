"""Model transforms: staging, roll-ups, marts and data-quality checks.

Every function maps DataFrames to a DataFrame with built-in Column
expressions only, so Catalyst can inline, prune and push down across models.
"""
