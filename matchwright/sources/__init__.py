"""Reading loosely formatted text and storing tables."""
