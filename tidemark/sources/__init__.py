"""Readers (streams, tables) and writers."""
