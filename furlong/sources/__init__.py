"""Readers that turn files and pages into DataFrames."""
