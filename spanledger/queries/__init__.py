"""Registered queries, each beside its SQL."""
