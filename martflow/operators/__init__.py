"""Reusable relational operators: DataFrame in, lazy DataFrame out."""
