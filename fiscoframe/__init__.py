"""Fiscal audit analytics written as ordinary Spark DataFrame plans.

Every public function takes DataFrames and returns DataFrames.  ``cnpj`` (the
taxpayer id) is a column of every table, so one plan serves all taxpayers and a
single taxpayer is just a filter that prunes partitions.
"""

__version__ = "0.1.0"
