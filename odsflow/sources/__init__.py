"""Readers and writers at the edges: databases, text, files, partitions."""
