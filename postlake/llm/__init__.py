"""Operators of a large-scale training-data pipeline.

Each module is one operator over a DataFrame of documents (or pages) and is
built by the method its docstring names.  Nothing else in the library imports
this subpackage.
"""
