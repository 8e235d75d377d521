"""Training-data operators (weak-supervision PII, deduplication, decontamination,
token counts, packing, toxicity, similarity join, chat formatting, ANN search).

Nothing outside this subpackage imports it.
"""
