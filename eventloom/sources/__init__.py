"""Readers and writers."""

from eventloom.sources.readers import read_table
from eventloom.sources.writers import save

__all__ = ["read_table", "save"]
