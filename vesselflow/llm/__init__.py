"""Training-data operators (tokens, classifiers, deduplication, packing, quality).

Nothing else in the library imports this subpackage; its queries are in
``llm.queries`` and the pipeline over them in ``corpus_pipeline.py``.
"""
