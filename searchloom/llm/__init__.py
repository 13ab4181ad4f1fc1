"""Operators of a training-data pipeline: cleaning, de-duplication, scans, packing.

Nothing else in the library imports this package.
"""
