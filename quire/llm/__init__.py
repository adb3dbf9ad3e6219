"""Training-data operators: each module is one operator, ``queries`` registers them.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries only if it can be imported.
"""
