"""Structured Streaming form of the bronze feed."""
