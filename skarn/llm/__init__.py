"""Training-data operators: each module holds one operator with its own general interface.

Nothing outside this package imports it; ``queries.py`` binds the operators to the test tables.
"""
