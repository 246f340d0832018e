"""Readers of ordered text files and writers of result files."""
