"""Structured Streaming jobs: triggered, exactly once per file, restartable."""
