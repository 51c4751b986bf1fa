"""Structured Streaming: layer runs, the order feed, replay of files."""
