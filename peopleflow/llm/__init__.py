"""Operators for preparing training text: tokens, duplicates, secrets, quality, packing."""
