"""Structured Streaming forms of the file load and of the status poll."""
