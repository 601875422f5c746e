"""Readers and writers for the annotation file formats."""
