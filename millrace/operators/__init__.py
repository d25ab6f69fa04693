"""Operators: DataFrame in, DataFrame out. Writing is a separate, last step."""
