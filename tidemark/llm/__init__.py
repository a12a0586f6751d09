"""Training-data operators: de-duplication, filters, tokenisation, packing, sharding.

Each module holds one operator with its own general interface; ``queries``
registers the thin contract queries on top. Nothing else in the library
imports this subpackage.
"""
