"""Operators: DataFrame in, DataFrame out, plus the Column forms they use."""
