"""Operators for building a training corpus of documents."""
