"""Operators for large text corpora: one module each, with a general function and its query.

Every operator takes a DataFrame, uses only the columns it names (extra columns, also those
with clashing names, never reach it), and gives one result row per input row unless it says
otherwise. ``catalogue`` registers the queries.
"""
