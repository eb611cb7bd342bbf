"""Readers for files and topic logs."""
