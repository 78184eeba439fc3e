"""Readers and writers for dumps, documents, submissions, URL files and releases."""
