"""Incremental form of Job A for landing folders that keep receiving files."""
