"""Column helpers for text, dates and storage paths."""
