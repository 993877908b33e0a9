"""Catalog analytics on PySpark: facets, search, pricing rules, carts and curation."""
