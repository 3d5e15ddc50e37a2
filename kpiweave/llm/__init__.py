"""Operators of a training-data pipeline; see ``queries.py`` for what is registered.

Operators take a DataFrame and column names and return a DataFrame. They read only the columns they are told to, so
further columns, whatever their names, do no harm. Intermediate results that are read more than once are written under
the shared checkpoint folder (``stage.py``); nothing is kept on one executor only.
"""
