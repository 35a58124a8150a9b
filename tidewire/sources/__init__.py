"""Readers and path functions."""
