"""Operators for large text corpora (training-data preparation).

Nothing outside this package imports it; ``corpus_pipeline.py`` at the
repository top belongs to it as well.
"""
