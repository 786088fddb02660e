"""Operators over whole tables."""
