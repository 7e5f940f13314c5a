"""Readers and sinks. Files are read as text columns and converted explicitly."""
