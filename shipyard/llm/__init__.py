"""Operators of a training-data pipeline: packing, near and exact duplicate
removal, mixing, quality scores, secret scans, exact search, token counts.

Nothing else in the library imports this subpackage.
"""
