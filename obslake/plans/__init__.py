"""Whole analyses put together from the operators, one module per kind of source."""
