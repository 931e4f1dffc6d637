"""Readers and writers. Only this package and ``streaming`` touch storage."""
