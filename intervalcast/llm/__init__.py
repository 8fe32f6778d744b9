"""Operators over text collections for training data; nothing else in the library uses them."""
