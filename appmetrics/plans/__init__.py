"""Compositions of operators, and the catalog of registered queries."""
