"""Operators for preparing training data for language models, and their queries.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it; the
driver entry adds its queries when the folder is there.  Each module holds
one operator with its own general interface; ``queries`` derives the digest
columns of the registered queries from them.
"""
