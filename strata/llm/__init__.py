"""Training-data operators: thirteen stand-alone jobs over documents, vectors,
pages and conversations.

Nothing else in the library imports this package. Each module holds one
operator with a general interface; ``queries.py`` derives the registered
``opN_<name>`` queries from them and ``oracles.py`` their SQL where SQL can
state the result.
"""
