"""Posting analytics on Spark: generic DataFrame operators and a preset that wires them together."""
