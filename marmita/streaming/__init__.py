"""Structured Streaming runner."""
