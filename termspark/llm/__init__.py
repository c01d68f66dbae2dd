"""Training-data pipeline operators.

Thirteen operators over ``documents``, ``embeddings``, ``pages``, ``labels`` and ``conversations``.  Nothing
else in the library imports this subpackage.  ``queries.py`` registers one thin query
per operator, ``oracle.py`` holds the SQL twins of those that SQL can express.
"""
