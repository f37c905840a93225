"""Operators for building language-model training data; nothing outside imports this."""
