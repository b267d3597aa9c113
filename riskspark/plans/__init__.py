"""Registered queries (``catalog``) and their oracle SQL (``sqlbase``)."""
