"""Registered queries, and plain SQL over the flat tables that states the same results."""
