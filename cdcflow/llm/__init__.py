"""Training-data operators: dedup, search, packing, mixing, scans, filters, chat.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
