"""Operators for preparing language-model training text, one module per operator."""
