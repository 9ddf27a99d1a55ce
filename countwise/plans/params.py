"""Fixed parameters of the registered queries.

Every approximate operator is deterministic once its parameters are
fixed; the same values feed the Spark plans and the DuckDB oracle SQL.
"""

from __future__ import annotations

from countwise.functions.hashing import (
    PRIME,
    LinearParams,
    bucket_params,
    color_params,
    four_wise_family,
    hash_family,
)
from countwise.operators.heavy import dyadic

# Graph algorithms: number of colours / subsets C, one colouring (a, b),
# R seeded colourings for the median, and the seeded subset hash.
COLORS = 4
COLORING = LinearParams(1234, 567)
RUNS = 5
RUN_SEED = 42
RUN_PARAMS = color_params(RUN_SEED, RUNS, PRIME)
BUCKETS = 4
BUCKET_SEED = 7
BUCKET_PARAMS = bucket_params(BUCKET_SEED, PRIME)

# Word count with random keys.
SALT_KEYS = 8
SALT_SEED = 1

# Count sketch over the item stream: D x W, range [LEFT, RIGHT], top K.
SKETCH_D = 5
SKETCH_W = 128
SKETCH_SEED = 42
FAMILY = hash_family(SKETCH_SEED, SKETCH_D, PRIME)
# An even depth: the median of D estimates is then the truncated mean of
# the middle two (N1's even branch).
FAMILY_EVEN = hash_family(SKETCH_SEED + 1, 4, PRIME)
# All non-negative 32-bit items: the reference's item type.
LEFT = 0
RIGHT = 2_147_483_647
# Least right end of the interval whose every integer is estimated; larger
# items of the table move it up.
INTERVAL_RIGHT = 999_999
# An inner interval, for the keys whose feature is the cut.
INNER_LEFT = 50
INNER_RIGHT = 149
TOP_K = 10
# Dyadic sketch of [LEFT, RIGHT]: heavy items without enumerating the interval.
DYADIC = dyadic(LEFT, RIGHT, SKETCH_D, 1 << 14, SKETCH_SEED)
# Four-wise independent signs: F2 within a few percent.
FOUR_WISE_W = 1024
FOUR_WISE = four_wise_family(SKETCH_SEED, SKETCH_D)
# Parts whose distinct items are sketched apart, and buckets of stored results.
DISTINCT_PARTS = 4
RESULT_BUCKETS = 8

# Streaming: parts in which a table arrives, and the prefix lengths N.
STREAM_ARRIVALS = 4
PREFIX_ITEMS = 25_000
PREFIX_USERS = 4_000
