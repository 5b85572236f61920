"""Operators for preparing text corpora; nothing else in the package imports them."""
