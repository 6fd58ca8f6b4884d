"""Structured Streaming over topic logs."""
