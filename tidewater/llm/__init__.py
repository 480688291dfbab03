"""Operators of a training-data pipeline over ``documents`` and ``embeddings``.

Nothing outside this package imports it.  Every operator takes DataFrames and
returns DataFrames; :mod:`queries` holds the registered queries and their SQL.

Conventions shared by all operators of the package:

* a null text counts as empty; a null ``doc_id`` is an id like any other
  (it sorts last), so no row is lost;
* only the columns an operator needs are selected from its input, so extra
  columns, whatever their names, neither clash nor travel;
* an empty input gives an empty result with the same schema.
"""
