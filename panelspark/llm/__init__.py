"""Operators for preparing language-model training data, each a function from DataFrame to DataFrame."""
