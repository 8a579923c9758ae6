"""Structured Streaming over the stage: new files are loaded as they arrive."""
