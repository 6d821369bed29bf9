"""Training-data operators: search, filters, near-duplicate joins, packing.

Nothing else in the library imports this package.  ``queries`` registers one
query per operator; the operators themselves take and return DataFrames.
"""
