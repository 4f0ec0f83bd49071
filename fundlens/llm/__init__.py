"""Operators of a training-data pipeline: decontamination, WARC, dedup, near duplicates, scoring, packing.

Each module holds one operator with its general interface; ``catalog`` registers
the queries over the ``documents``, ``pages``, ``benchmark`` and ``labels`` tables
and their SQL. Nothing outside this package imports it except the guarded lines of
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
