"""Operators for preparing training data, each with its registered query.

mixing      1  sources mixed to target weights by systematic sampling
suffixes    2  repeated byte passages found with blockwise suffix arrays
chat        3  one rendering of a dialogue for each participant
toxicity    4  weighted finite-state grammar over clauses
winnow      5  winnowed fingerprints
packing     6  pattern packing by non-negative least squares
jaccard     7  grouped prefix join on word shingles
quality     8  histogram gradient-boosted trees over document statistics
graph       9  robust-pruned search graphs, one for each shard
warc        10 chunked WARC record table
lexical     11 ranked lexical search over K2-treaps
bpe         12 BPE encoding and decoding with a merge queue
variants    13 spelling variants found with pivotal grams
queries        the registered queries and their SQL
"""
