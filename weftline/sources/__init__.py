"""Readers and writers for the text formats the pipelines exchange."""
