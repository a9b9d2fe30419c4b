"""Readers and writers for topics, text folders, dimensions and test tables."""
