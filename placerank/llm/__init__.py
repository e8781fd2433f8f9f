"""Operators of a training-data pipeline over documents, embeddings and pages; one module each.

lm        scoring with an Elias-Fano n-gram trie          quality   subword embedding classifier
packing   minimum bin slack                               vectors   product quantisation near-dedup
exact     minimal perfect hash over digests               simhash   multi-index hashing near-dedup
warc      archive converter                               sharding  balanced label propagation
mixing    time-varying curriculum                         substring recompression
squares   runs by dyadic square catching                  toxicity  compression-distance classifier
merkle    manifest with octopus multiproofs

queries.py registers one query per operator, with its SQL where SQL can express it.
"""
