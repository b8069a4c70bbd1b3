"""Operators for preparing large text corpora (see README, "Corpus operators").

Nothing else in the library imports this subpackage; the queries are in
``queries.py``, the pipeline in ``corpus_pipeline.py`` at the repository top.
"""
