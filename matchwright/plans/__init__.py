"""Composed tables: cleaned sources, features, groups, assignments and reports."""
