"""Training-data operators: fingerprints, packing, language-model scores,
token counts, token-id files, URL filters, near-duplicate joins, byte-level
BPE, quality rules and toxicity, with their registered queries.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
