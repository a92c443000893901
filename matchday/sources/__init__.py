"""Readers: landed JSON documents, records and tables."""
