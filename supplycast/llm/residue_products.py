"""Exact integer inner products by a residue number system on float32 matrix products.

Components are reduced modulo several small primes to the symmetric range, each pair of matrices is
multiplied in float32 (all partial sums stay below 2^24, so every product is exact), and the signed
result follows from its residues by mixed-radix Chinese remaindering.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: the moduli, largest primes below 2^9; as many are used as the largest possible result needs
PRIMES = (509, 503, 499, 491, 487, 479, 467, 463)
#: components of one float32 product: this many squares of 254 stay below 2^24
DEPTH = 2**24 // 254**2


def n_primes(bound: int) -> int:
    """Moduli that tell all integers of at most this size apart."""
    product, n = 1, 0
    while product < 2 * bound + 1:
        if n == len(PRIMES) or bound >= 2**63:
            raise ValueError(f"inner products up to {bound} do not fit 64 bits")
        product, n = product * PRIMES[n], n + 1
    return max(n, 1)


def _symmetric(values: np.ndarray, prime: int) -> np.ndarray:
    half = prime // 2
    return (values + half) % prime - half


class Residues(NamedTuple):
    """Per prime the float32 matrix of one side."""

    parts: list[np.ndarray]

    @classmethod
    def of(cls, matrix: np.ndarray, primes: int) -> Residues:
        return cls([_symmetric(matrix, p).astype(np.float32) for p in PRIMES[:primes]])

    def rows(self, start: int, end: int) -> Residues:
        return Residues([x[start:end] for x in self.parts])


def products(left: Residues, right: Residues) -> np.ndarray:
    """Inner products of all rows of the left with all of the right matrix, as int64.

    Exact where the true values are at most the bound that the number of primes was chosen for.
    """
    digits: list[np.ndarray] = []
    total, weight = np.zeros((len(left.parts[0]), len(right.parts[0])), np.int64), 1
    for p, a, b in zip(PRIMES, left.parts, right.parts, strict=False):
        rest = np.zeros(total.shape, np.int32)
        for k in range(0, a.shape[1], DEPTH):
            rest += (a[:, k : k + DEPTH] @ b[:, k : k + DEPTH].T).astype(np.int32) % p
        for digit, q in zip(digits, PRIMES, strict=False):
            rest = (rest - digit) * pow(q, -1, p) % p
        digits.append(_symmetric(rest, p))
        # wraps around like the sum does, and the sum ends in range
        total += digits[-1] * np.array(weight % 2**64, np.uint64).astype(np.int64)
        weight *= p
    return total
