"""Operators of a training-data pipeline, each a Spark job over `documents`.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
``catalog.py`` registers one query per operator.
"""
