"""Preference-data curation on Spark DataFrames.

Functions take and return DataFrames or Columns; nothing here keeps global state.
"""
