"""Training-data operators: tokenisation, near-duplicates, filters, storage and mixing.

Every module here is one operator over DataFrames; ``queries`` registers one
query per operator and ``store`` / ``components`` / ``tiles`` are their common
helpers. Nothing outside this package imports it.
"""
