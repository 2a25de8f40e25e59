"""Relational operators over tiles, cells, landmarks and archives."""
