"""Training-data operators: ten corpus operators, each with its query.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
