"""Structured Streaming builders."""
