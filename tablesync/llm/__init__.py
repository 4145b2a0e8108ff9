"""Operators of a training-data pipeline over ``documents`` and ``embeddings``.

One module per operator; each has the operator (a general function over
DataFrames) and a thin ``query(spark, sf_dir)`` that derives the registered
columns.  Nothing else in the library imports this package.
"""
