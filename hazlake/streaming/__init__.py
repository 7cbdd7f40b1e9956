"""Structured Streaming intake: landing folders to bronze and to the keyed store."""
