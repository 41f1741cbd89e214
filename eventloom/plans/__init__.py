"""Declared pipelines: descriptions of tables and events, checks on them, and their compilation to lazy plans."""
