"""Operators for preparing training data: scoring, cleaning, deduplication, search and tokenizing of documents."""
