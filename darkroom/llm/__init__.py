"""Training-data operators: quality rules, mixing, near duplicates, extraction,
packing, licence scans, URL filters, vector search, repeated passages, sharding,
conversation tries, BPE encoding, tokenizer alignment.

Nothing outside this package imports it; `__spark_entry__.py` adds its queries
when it is present, and `corpus_pipeline.py` chains five of its operators.
"""
