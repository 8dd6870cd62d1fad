"""Operators for preparing training texts."""
