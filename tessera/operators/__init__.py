"""Recommendation operators: DataFrame in, DataFrame out."""
