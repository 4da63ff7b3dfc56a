"""Training-data operators for large text corpora.

Nothing else in the package imports this folder; ``queries.py`` registers one
query per operator.
"""
