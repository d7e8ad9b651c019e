"""Training-data operators: filtering, deduplication, tokens, shards and archives.

Nothing else in the library imports this subpackage.  Every operator takes a DataFrame and
names of its columns and returns a DataFrame; ``queries.py`` holds the registered queries.
"""
