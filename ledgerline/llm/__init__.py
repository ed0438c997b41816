"""Training-data operators (sharding, archives, deduplication, scans, tokens).

Nothing outside this package imports it; its queries are registered by
``ledgerline.llm.queries`` and its end-to-end job is ``corpus_pipeline.py``.
"""
