"""Operators for training-data corpora: sharding, token files, mixing, privacy, dedup, packing.

Nothing else in the library imports this subpackage.
"""
