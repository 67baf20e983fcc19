"""Training-data operators: ten operators over ``documents`` and ``pages``.

Nothing else in the library imports this package. Each module holds one
operator with its own general interface; ``queries.py`` derives the
registered digest columns from them.
"""
