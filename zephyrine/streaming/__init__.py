"""The batch operators on arriving files."""
