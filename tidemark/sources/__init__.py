"""Readers and writers for the file formats the jobs exchange."""
