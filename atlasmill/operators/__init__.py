"""Operators on DataFrames: lookups, spatial joins, matching, components, history, merging, calibration."""
