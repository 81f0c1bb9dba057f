"""Operators of a training-data pipeline (fingerprints, classifiers, tokens, shards).

Nothing outside this folder imports it.  ``queries`` registers one query per
operator; every other module holds one operator behind its own interface.
"""
