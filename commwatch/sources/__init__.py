"""Readers of lines, corpora and dimensions."""
