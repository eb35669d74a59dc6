"""Structured Streaming: file arrival to landing, landing to silver, periodic runs."""
