"""Structured Streaming flows."""
