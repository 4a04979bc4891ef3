"""Training-data operators: packing, licence scan, fingerprints, similarity
join, quality, PII, toxicity, token files, mixing and exact dedup.

Nothing else in the library imports this subpackage.
"""
