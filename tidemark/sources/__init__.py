"""Readers and gates of source files, and writers."""
