"""Incremental file loads with Structured Streaming."""

from stratiform.streaming.file_load import load_evolving_files, load_new_files

__all__ = ["load_evolving_files", "load_new_files"]
