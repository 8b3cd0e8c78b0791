"""Schemas, raw landing, bronze files and layer tables."""
