"""Operators that prepare training data for language models; nothing outside imports them."""
