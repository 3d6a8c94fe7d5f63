"""Operators for training-data pipelines over a table of documents.

Each module holds one operator with a general interface over DataFrames; ``queries`` registers one ``opN_<name>``
query per operator and the pipeline. Nothing outside this subpackage imports it.
"""
