"""Matching parameters."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

# Defaults that decide which pairs are reported.
SHINGLE_SIZE = 1
NUM_HASHES = 60
ROWS_PER_BAND = 3
JACCARD_THRESHOLD = 0.15
MERSENNE_PRIME = 2147483647


@dataclass(frozen=True)
class MatchParams:
    shingle_size: int = SHINGLE_SIZE
    num_hashes: int = NUM_HASHES
    rows_per_band: int = ROWS_PER_BAND
    threshold: float = JACCARD_THRESHOLD
    prime: int = MERSENNE_PRIME
    seed: int = 7

    def __post_init__(self) -> None:
        if self.shingle_size < 1:
            raise ValueError("shingle_size must be at least 1")
        if not 1 <= self.rows_per_band <= self.num_hashes:
            raise ValueError("rows_per_band must lie in 1..num_hashes")
        if not 0.0 < self.threshold <= 1.0:
            raise ValueError("threshold must lie in (0, 1]")
        # a * x + b with x < 2**32 has to stay inside a signed 64-bit integer
        if not 2 <= self.prime <= MERSENNE_PRIME:
            raise ValueError("prime must lie in 2..2**31-1")

    @property
    def num_bands(self) -> int:
        return self.num_hashes // self.rows_per_band

    def hash_family(self) -> list[tuple[int, int]]:
        return hash_family(self.num_hashes, self.prime, self.seed)


def _draw(seed: int, index: int, role: str) -> int:
    digest = hashlib.blake2b(f"{seed}/{index}/{role}".encode(), digest_size=8)
    return int.from_bytes(digest.digest(), "big")


def hash_family(num_hashes: int, prime: int, seed: int) -> list[tuple[int, int]]:
    """Coefficients of ``x -> (a*x + b) mod prime``: 1 <= a < prime, 0 <= b < prime.

    Derived from the seed alone, so every executor, restart and library version
    gets the same family and a stored band index stays valid.
    """
    return [
        (1 + _draw(seed, i, "a") % (prime - 1), _draw(seed, i, "b") % prime)
        for i in range(num_hashes)
    ]
