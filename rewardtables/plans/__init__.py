"""Registered queries, the derived tables they run on, and their SQL equivalents."""
