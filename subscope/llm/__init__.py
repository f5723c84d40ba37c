"""Preparation of training text: filters, duplicates, tokens, packing and scoring."""
