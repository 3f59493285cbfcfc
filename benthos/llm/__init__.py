"""Training-data operators: packing, near-dedup, token counts, extraction, filters.

Nothing outside this folder (and corpus_pipeline.py) imports it.
"""
