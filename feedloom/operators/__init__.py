"""Operators on feeds, pages, steps and records. All take and return DataFrames or Columns."""
