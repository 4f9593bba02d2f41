"""Operators that prepare text and vectors for training; nothing outside this folder imports them."""
