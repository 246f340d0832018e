"""Operators for training-data pipelines over ``documents`` and ``conversations``.

Nothing else in the library imports this subpackage. ``queries`` holds the
registered queries, ``oracles`` the SQL that checks those SQL can express.
"""
