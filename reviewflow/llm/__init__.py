"""Operators that prepare training text. Nothing else in the package imports them."""
