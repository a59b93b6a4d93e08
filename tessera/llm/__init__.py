"""Training-data operators: each module holds one operator, ``queries`` applies them to whole tables.

Nothing outside this subpackage (but ``corpus_pipeline.py`` and the guarded
registration in ``__spark_entry__.py``) imports it.
"""
