"""Streaming twins of marts."""
