"""Operators for cleaning, measuring and tokenising text collections."""
