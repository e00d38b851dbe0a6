"""Registered queries with their SQL check."""
