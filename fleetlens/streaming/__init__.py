"""Structured Streaming jobs that replace blocking poll loops."""
