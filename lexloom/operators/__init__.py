"""Relational operators on tables of rows, terms and vectors."""
