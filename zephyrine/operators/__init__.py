"""Relational operators over readings and feature tables."""
