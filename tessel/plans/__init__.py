"""Registered queries and plan helpers."""
