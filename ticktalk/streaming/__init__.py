"""Structured Streaming: windows, and the flows from raw messages to sinks."""
