"""Thin queries: each derives its columns from an operator's output."""
