"""Relational operators of the attrition pipeline, each DataFrame in,
DataFrame out."""
