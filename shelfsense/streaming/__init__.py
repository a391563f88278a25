"""Structured Streaming: live recent lists and rating upserts."""
