"""Readers that turn files and nested documents into tables."""
