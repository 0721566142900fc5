"""Operators of a training-data pipeline, each one module of this subpackage.

Nothing else in the library imports it. Every operator takes and returns
DataFrames, keeps the work in Spark (shuffles, aggregations, joins, Arrow
batches in tasks) and passes no unbounded data through the driver, one task or
one group.

Conventions shared by all operators:

* ``doc_id`` and ``text`` are the only columns read; any other column, whatever
  its name, is ignored by the digest queries and carried by the pipeline.
* A null ``text`` counts as the empty text unless the operator says otherwise.
* A null ``doc_id`` counts as the largest id (it never wins a tie).
* Rows that repeat a ``(doc_id, text)`` pair all get that pair's result.
* An empty table gives an empty result with the same columns.
"""
