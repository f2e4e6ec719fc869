"""Operators for preparing training data: deduplication, quality, extraction,
tokenisation, sharding and filters.  Nothing else in the library imports this
subpackage."""
