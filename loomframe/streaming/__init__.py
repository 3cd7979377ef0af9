"""Fitted transforms on streams."""
