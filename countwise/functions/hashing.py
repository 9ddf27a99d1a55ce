"""Linear hashes mod a prime, as JVM column expressions (no UDF).

``h(x) = ((a*x + b) mod p) mod m`` is evaluated as
``pmod(pmod(a * pmod(x, p) + b, p), m)``: the id is reduced mod p before
the product, so nothing overflows for any BIGINT id (Spark runs in ANSI
mode, where an overflowing product raises), and ``pmod`` keeps colours
of negative ids in ``[0, m-1]``.  For 0 <= x the value equals the plain
formula.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the prime of every hash in the reference programs.
PRIME = 8191


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def _n(x) -> Column:
    """Numeric parameter: a Python int becomes a BIGINT literal."""
    return F.lit(x).cast("bigint") if isinstance(x, int) else _c(x).cast("bigint")


#: Largest prime whose products stay within BIGINT: p^2 + 2p < 2^63.
MAX_PRIME = 2_147_483_647


def check_prime(p: int) -> int:
    """p, if every hash of this module stays within BIGINT with it."""
    if not 2 <= p <= MAX_PRIME:
        raise ValueError(f"the prime must be between 2 and {MAX_PRIME}: {p}")
    return p


def linear_hash(x, a, b, m, p: int = PRIME) -> Column:
    """((a*x + b) mod p) mod m, always in [0, m-1]."""
    check_prime(p)
    xp = F.pmod(_c(x).cast("bigint"), F.lit(p).cast("bigint"))
    inner = F.pmod(_n(a) * xp + _n(b), F.lit(p).cast("bigint"))
    return F.pmod(inner, _n(m))


def sign_hash(x, a, b, p: int = PRIME) -> Column:
    """g(x): -1 when the linear hash mod 2 is 0, else +1 (BIGINT)."""
    return F.when(linear_hash(x, a, b, 2, p) == 0, F.lit(-1).cast("bigint")) \
        .otherwise(F.lit(1).cast("bigint"))


def vertex_color(x, num_colors: int, a, b, p: int = PRIME) -> Column:
    """h_C(x) of the node-colouring algorithms."""
    return linear_hash(x, a, b, num_colors, p)


def edge_hash(u, v, params: "BucketParams", p: int = PRIME) -> Column:
    """(a*u + b*v + c) mod p of an edge."""
    pp = F.lit(check_prime(p)).cast("bigint")
    uu = F.pmod(_c(u).cast("bigint"), pp)
    vv = F.pmod(_c(v).cast("bigint"), pp)
    # The first product is reduced before the second is added: no overflow.
    first = F.pmod(_n(params.a) * uu + _n(params.c), pp)
    return F.pmod(first + _n(params.b) * vv, pp)


def edge_bucket(u, v, num_buckets: int, params: "BucketParams", p: int = PRIME) -> Column:
    """Deterministic random subset of an edge: ((a*u + b*v + c) mod p) mod C.

    A row hash instead of ``rand()``: both branches of a self-join see the
    same bucket for the same edge, and a retried task reproduces it.
    """
    return F.pmod(edge_hash(u, v, params, p), F.lit(num_buckets).cast("bigint"))


@dataclass(frozen=True)
class LinearParams:
    a: int
    b: int


@dataclass(frozen=True)
class BucketParams:
    a: int
    b: int
    c: int


@dataclass(frozen=True)
class SketchRow:
    """Hash pair of one sketch row j: h_j = (ah, bh), g_j = (ag, bg)."""
    j: int
    ah: int
    bh: int
    ag: int
    bg: int


def draw_linear(rng: random.Random, p: int = PRIME) -> LinearParams:
    """a uniform in [1, p-1], b uniform in [0, p-1]."""
    return LinearParams(rng.randint(1, p - 1), rng.randint(0, p - 1))


def color_params(seed: int, runs: int, p: int = PRIME) -> list[LinearParams]:
    """One colouring (a, b) per run, reproducible from ``seed``."""
    rng = random.Random(seed)
    return [draw_linear(rng, p) for _ in range(runs)]


def bucket_params(seed: int, p: int = PRIME) -> BucketParams:
    rng = random.Random(seed)
    return BucketParams(rng.randint(1, p - 1), rng.randint(1, p - 1), rng.randint(0, p - 1))


def hash_family(seed: int, depth: int, p: int = PRIME) -> list[SketchRow]:
    """2*D linear hashes: rows 0..D-1 give h_j, rows D..2D-1 give g_j."""
    if depth < 1:
        raise ValueError("sketch depth D must be >= 1")
    rng = random.Random(seed)
    pairs = [draw_linear(rng, p) for _ in range(2 * depth)]
    return [SketchRow(j, pairs[j].a, pairs[j].b, pairs[j + depth].a, pairs[j + depth].b)
            for j in range(depth)]


def cubic_hash(x, coefficients: Sequence, p: int = MAX_PRIME) -> Column:
    """((c3*x + c2)*x + c1)*x + c0 mod p: four-wise independent for random
    coefficients and x < p.  Every product is reduced before the next, so
    nothing overflows for p up to ``MAX_PRIME``."""
    check_prime(p)
    pp = F.lit(p).cast("bigint")
    xp = F.pmod(_c(x).cast("bigint"), pp)
    value = _n(coefficients[0])
    for c in coefficients[1:]:
        value = F.pmod(value * xp + _n(c), pp)
    return value


@dataclass(frozen=True)
class FourWiseRow:
    """One sketch row with a linear cell hash (ah, bh) and a cubic sign hash."""
    j: int
    ah: int
    bh: int
    g: tuple[int, int, int, int]


def four_wise_family(seed: int, depth: int, p: int = MAX_PRIME) -> list[FourWiseRow]:
    if depth < 1:
        raise ValueError("sketch depth D must be >= 1")
    rng = random.Random(seed)
    return [FourWiseRow(j, rng.randint(1, p - 1), rng.randint(0, p - 1),
                        (rng.randint(1, p - 1), *(rng.randint(0, p - 1) for _ in range(3))))
            for j in range(depth)]


def family_struct_array(family: list[SketchRow]) -> Column:
    """The family as a literal ARRAY<STRUCT<j,ah,bh,ag,bg>>.

    Exploding it replicates a row once per sketch row without a join; the
    array is part of the plan, its size is D.
    """
    return F.array(*[
        F.struct(F.lit(r.j).cast("bigint").alias("j"), F.lit(r.ah).cast("bigint").alias("ah"),
                 F.lit(r.bh).cast("bigint").alias("bh"), F.lit(r.ag).cast("bigint").alias("ag"),
                 F.lit(r.bg).cast("bigint").alias("bg"))
        for r in family
    ])
