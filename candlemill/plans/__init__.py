"""Batch jobs over the lake."""
