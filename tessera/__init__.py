"""Tessera: a PySpark-native engine for building, auditing and releasing large datasets.

Every operator takes and returns DataFrames or Columns; Catalyst picks the physical plan.
The optional subpackage ``tessera.llm`` holds the operators for training text; nothing here imports it.
"""
