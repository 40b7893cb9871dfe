"""Question-answering, retrieval and preference corpora as Spark DataFrames.

Every operator takes a DataFrame (plus parameters) and returns a DataFrame, so
chains are written with ``df.transform(op, ...)``.  Every function takes column
names or Columns and returns a Column.
"""

__version__ = "0.1.0"
