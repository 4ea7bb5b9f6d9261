"""Reusable DataFrame operators: loads, versions, lookups, checks, row filters."""
