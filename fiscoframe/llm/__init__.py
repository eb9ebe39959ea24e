"""Operators for preparing training corpora, and the queries that apply them.

Every operator takes DataFrames and returns DataFrames; models, tables and indexes
that an operator needs on the way are built from the data it is given.
"""
