"""Structured Streaming: landing raw messages, tallying feeds, raising stall alarms."""
