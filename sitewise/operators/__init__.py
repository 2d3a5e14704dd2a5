"""Routing, fragments, analytics, changes, maintenance, checks."""
