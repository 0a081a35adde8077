"""Relational operators that are more than one built-in call."""
