"""Operators for preparing training data for language models.

Nothing else in the library imports this subpackage. Every operator takes DataFrames and names of the columns
it reads, ignores all other columns, and returns only the columns its docstring lists.
"""
