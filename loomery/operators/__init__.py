"""Operators: DataFrame in, DataFrame out; nothing is collected in a transform."""
