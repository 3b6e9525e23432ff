"""adledger: a PySpark-native engine for classified-listing data.

Every operator takes DataFrames (or Columns) and returns DataFrames (or
Columns); column names are arguments, so the same code runs on any table.
"""
