"""Readers and generators of requests, documents and messages."""
