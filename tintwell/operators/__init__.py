"""Relational operators over lineage, annotation, extraction and colour tables."""
