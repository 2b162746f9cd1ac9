"""Structured Streaming: sources, windowed counts and sinks."""
