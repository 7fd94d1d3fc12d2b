"""Readers and writers of the file formats around the store."""
