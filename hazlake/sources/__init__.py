"""Readers and writers: landed lines, payloads, article pages, media files, tables."""
