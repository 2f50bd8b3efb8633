"""Registered queries: each operator on inputs derived from the driver tables, with its SQL."""
