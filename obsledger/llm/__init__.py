"""Operators for preparing training text at scale: packing, near duplicates, filters, mixing, materialisation.

Nothing else in the package imports this subpackage. Every module holds one operator with a general interface;
``registered`` holds the queries that apply them to whole tables.
"""
