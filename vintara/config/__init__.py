"""Canonical layouts, alias tables and value dictionaries, as data."""
