"""Training-data operators: dedup, packing, filters, tokenizing, sharding, scoring.

One module per operator; ``queries`` registers one thin query per operator.
Nothing outside this subpackage (and ``corpus_pipeline``) imports it.
"""
