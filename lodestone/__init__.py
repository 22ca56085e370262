"""Catalog analytics on Spark: from information_schema relations to typed catalog entities."""
