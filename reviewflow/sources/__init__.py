"""Readers of files, topics and literal rows."""
