"""Operators for text corpora that become training data. Nothing else in the library imports them."""
