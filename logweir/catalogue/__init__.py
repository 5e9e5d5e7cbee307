"""Queries over the sample tables that exercise every operator, with an equivalent SQL text for each."""
