"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries only when it can be imported. One module per operator:

    ann             randomly rotated one-bit codes, nearest neighbours
    wrappers        wrapper inference over same-host pages, main text
    toxicity        subsequence-kernel SVM with Nystroem landmarks
    mixing          hierarchical token budgets and seeded epochs
    warc            gzip WARC normaliser with a sidecar offset index
    decontaminate   benchmark n-grams as a broadcast hash set
    suffix_dedup    column-wise multi-document BWT, repeated byte strings
    simhash         fingerprints linked by the generalised pigeonhole rule
    pii             keyed type-consistent surrogates
    lattice_lm      marginal likelihood over all segmentations
    merkle          Merkle manifest and octopus multiproofs
    spelling        spelling variants by prefix-suffix tiles
    minhash_forest  near-duplicates by an LSH forest
    queries         the registered queries and their SQL
"""
