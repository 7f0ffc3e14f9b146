"""Readers and writers for raw files and stored layers."""
