"""Operators for preparing training data: texts, conversations and web pages."""
