"""Readers, reshapers and writers of measurement tables."""
