"""Transforms and reports composed from the generic operators."""
