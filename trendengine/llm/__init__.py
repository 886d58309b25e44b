"""Operators for preparing training text. Nothing outside of this subpackage imports it."""
