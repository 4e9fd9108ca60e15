"""Builders of the three wide tables, checks, reports and lookups."""
