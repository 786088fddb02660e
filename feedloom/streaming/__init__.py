"""Streaming forms of the keyed state."""
