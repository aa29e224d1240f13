"""Compositions of operators into the tables of a valuation study."""
