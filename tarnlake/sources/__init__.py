"""Readers and writers for the storage layers."""
