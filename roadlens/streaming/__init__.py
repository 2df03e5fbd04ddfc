"""Structured Streaming: live flow per monitor and pass feeds."""
