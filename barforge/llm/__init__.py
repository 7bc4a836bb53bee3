"""Training-data operators (near-dedup, mixing, WARC, chat, scans, packing, quality).

Nothing outside this package, ``corpus_pipeline.py`` and ``tests/llm``
imports it; the rest of the library works without it.
"""
