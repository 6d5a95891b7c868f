"""Training-data operators: one module per operator, queries in ``queries.py``.

Nothing outside this subpackage imports it, except the guarded registration in
``__spark_entry__.py`` and the pipeline in ``corpus_pipeline.py``.
"""
