"""Training-data pipeline operators.

Nothing else in the library imports this subpackage; ``queries.py`` and
``sql.py`` hold its registered queries, ``__spark_entry__.py`` adds them when
the subpackage can be imported.
"""
