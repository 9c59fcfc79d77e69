"""Training-data operators: ten Spark jobs over document and embedding tables.

Nothing outside this subpackage imports it, so it can be removed as a whole.
"""
