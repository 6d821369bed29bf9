"""Warehouse layers as DataFrame functions over domain-named tables."""
