"""Operators for preparing training text: language, likeness, cleaning, mixing, search and tokens."""
