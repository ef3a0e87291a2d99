"""Training-data operators: packing, near-duplicates, mixing, web archives,
sharding, quality, secrets, fingerprints, exact search, toxicity.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it; the
operators take DataFrames and column names, the thin registered queries live in
``valuora.llm.queries``.
"""
