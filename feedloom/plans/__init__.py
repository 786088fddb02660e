"""Whole jobs put together from the operators, and the queries on the test tables."""
