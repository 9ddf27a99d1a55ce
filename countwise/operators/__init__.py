"""DataFrame -> DataFrame operators.

words       P1, A2-A6: tokens, per-document and global word counts (one round,
            salted two rounds, per-partition two rounds), distinct-word stats
triangles   S3 core, P5-P7, J1-J3, A7-A11, T4-T8: oriented adjacency counting,
            node colouring, runs median, edge subsets, colour triplets
frequency   P8, K1-K10, A13: exact frequencies, count sketch, estimates,
            second moments, top-K with ties, sketch error, distinct items
"""
