"""Readers: JSON lines, delimited lines, INSERT dumps, and day directories."""
