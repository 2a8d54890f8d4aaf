"""Operators for large-scale training-data pipelines (sharding, search, language
models, archives, mixing, packing, near-duplicate joins, language ID, token files).

Nothing else in the library imports this subpackage.
"""
