"""Whole flows built from the operators, and the queries bound to the test tables."""
