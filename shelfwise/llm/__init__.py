"""Operators for preparing training text. Nothing else in the library imports this package.

Rules shared by all operators, unless a docstring says otherwise:

* Only the named key and text columns are read; other columns, whatever their names, are ignored.
* A null text counts as an empty one. Keys may be null or repeat: every input row gives one output
  row, and equal rows give equal output rows.
* An empty table gives an empty result of the same schema.
* Intermediate tables go to the folder in ``spark.checkpoint.dir``.
"""
