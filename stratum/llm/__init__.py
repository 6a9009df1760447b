"""Operators for training-data pipelines over large text and vector tables.

Each module holds one operator (general interface) and, at its end, the query
that applies it to the given tables. Nothing else in the library imports this
package; ``registry`` lists its queries and SQL statements.
"""
