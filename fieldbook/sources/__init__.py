"""Readers of landed source pages and manual sheets; table sinks."""
