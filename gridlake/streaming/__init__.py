"""Structured Streaming: decode, check, dedupe, alert, roll up."""
