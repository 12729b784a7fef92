"""Eigenvalues and eigenvectors of an integer scatter matrix from its exact characteristic polynomial.

The polynomial is found modulo many primes (Hessenberg reduction, a task of its own for every prime) and put together by Chinese remaindering.
A positive semidefinite matrix has real roots only, so Descartes' rule is exact: the sign changes of the polynomial
shifted by c count the roots above c.  Bisection on that count isolates the largest roots and their multiplicities, further halving gives as many
digits as wanted.  Vectors come from inverse iteration in decimal arithmetic with the root as the shift: the solve blows up the null space.
All sizes here are bounded by the dimension, never by the number of rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from decimal import Decimal, localcontext
from math import comb

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGITS_BITS = 320  # relative width to which roots are narrowed: roots closer than that count as one of higher multiplicity
DECIMALS = 140
_WITNESSES = (2, 3, 5, 7)  # enough below 3,215,031,751


def is_prime(n: int) -> bool:
    if n < 2 or n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for a in _WITNESSES:
        if a % n == 0:
            continue
        x = pow(a, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes below 2^31, from the largest on, whose product exceeds the bound."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def hessenberg_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Similar upper Hessenberg matrix over the integers modulo p (p < 2^31; entries 0 to p - 1)."""
    h = matrix.copy()
    d = len(h)
    for k in range(d - 2):
        nonzero = np.flatnonzero(h[k + 1:, k])
        if not nonzero.size:
            continue
        at = k + 1 + nonzero[0]
        if at != k + 1:
            h[[k + 1, at]] = h[[at, k + 1]]
            h[:, [k + 1, at]] = h[:, [at, k + 1]]
        factor = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - factor[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * factor % p).sum(axis=1)) % p
    return h


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients, constant first, of det(x - matrix) modulo p."""
    h = hessenberg_mod(matrix, p)
    d = len(h)
    minors = np.zeros((d + 1, d + 1), dtype=np.int64)  # of the leading blocks
    minors[0, 0] = 1
    for k in range(1, d + 1):
        below, weights = 1, np.zeros(k, dtype=np.int64)
        for i in range(k - 1, -1, -1):  # column k of the block, times the product of the subdiagonal under it
            weights[i] = h[i, k - 1] * below % p
            below = below * int(h[i, i - 1]) % p if i else 0
            if not below:
                break
        minors[k, 1:] = minors[k - 1, :-1]
        minors[k] = (minors[k] - (weights[:, None] * minors[:k] % p).sum(axis=0)) % p
    return minors[d].tolist()


def coefficient_bound(trace: int, d: int) -> int:
    """No coefficient of a positive semidefinite matrix is larger (the symmetric means of its roots fall)."""
    mean = -(-trace // d)
    return max(comb(d, k) * mean ** k for k in range(d + 1))


def combined(residues: dict[int, list[int]]) -> list[int]:
    """Coefficients from their residues; their signs alternate, so sizes are what is put together."""
    product = 1
    for p in residues:
        product *= p
    d = len(next(iter(residues.values()))) - 1
    parts = [(product // p * pow(product // p, -1, p), found) for p, found in residues.items()]
    out = []
    for k in range(d + 1):
        sign = -1 if (d - k) % 2 else 1
        size = sum(part * (sign * found[k]) for part, found in parts) % product
        out.append(sign * size)
    return out


def shifted(poly: list[int], c: int) -> list[int]:
    """Coefficients of poly(x + c)."""
    out = list(poly)
    for i in range(len(out) - 1):
        for k in range(len(out) - 2, i - 1, -1):
            out[k] += c * out[k + 1]
    return out


def roots_above(poly: list[int], c: int) -> int:
    signs = [x > 0 for x in shifted(poly, c) if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value_at(poly: list[int], c: int) -> int:
    out = 0
    for x in reversed(poly):
        out = out * c + x
    return out


def _finer(poly: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2^bits times as large."""
    d = len(poly) - 1
    return [x << (bits * (d - k)) for k, x in enumerate(poly)]


def largest_roots(poly: list[int], count: int, bits: int = DIGITS_BITS) -> list[tuple[int, int, int]]:
    """(numerator, scale, multiplicity) of the largest positive roots, falling, until `count` of them are covered.

    The root lies in (numerator, numerator + 1] / 2^scale, a relative width of at most 2^-bits.
    """
    lowest = next(k for k, x in enumerate(poly) if x)
    poly = poly[lowest:]  # roots at zero are no components
    positive, d, out, covered = len(poly) - 1, len(poly) - 1, [], 0
    top = 1
    while d and roots_above(poly, top):
        top *= 2
    while covered < min(count, positive):
        scale, fine, low, high = 0, poly, 0, top
        above_low, above_high = positive, 0  # more than `covered` roots above low, at most so many above high
        while True:
            end = value_at(fine, high)
            while high - low > 1:
                middle = (low + high) // 2
                if above_low - above_high == 1 and end:  # one simple root between: the sign of the value tells the side
                    value = value_at(fine, middle)
                    inside = value != 0 and (value > 0) != (end > 0)
                else:
                    found = roots_above(fine, middle)
                    inside = found > covered
                    above_low, above_high = (found, above_high) if inside else (above_low, found)
                    end = end if inside else value_at(fine, middle)
                low, high = (middle, high) if inside else (low, middle)
            if low >> bits:
                break
            more = bits + 1 - low.bit_length() if low else bits
            scale, fine, low, high = scale + more, _finer(fine, more), low << more, high << more
        many = above_low - covered
        out.append((low, scale, many))
        covered += many
    return out


def null_vectors(matrix: list[list[int]], root: Decimal, many: int) -> list[list[Decimal]]:
    """Orthonormal vectors of the (nearly) null space of matrix - root, by inverse iteration from fixed starts."""
    with localcontext() as context:
        context.prec = DECIMALS
        d = len(matrix)
        a = np.array([[Decimal(x) for x in row] for row in matrix], dtype=object)
        for i in range(d):
            a[i, i] -= root
        order = np.arange(d)
        smallest = (abs(root) + 1).scaleb(-DECIMALS)
        for k in range(d):
            pivot = k + int(np.argmax(np.abs(a[k:, k])))
            if pivot != k:
                a[[k, pivot]] = a[[pivot, k]]
                order[[k, pivot]] = order[[pivot, k]]
            if abs(a[k, k]) < smallest:
                a[k, k] = smallest
            a[k + 1:, k] = a[k + 1:, k] / a[k, k]
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])

        def solved(b):
            x = b[order].copy()
            for k in range(d):
                x[k + 1:] -= a[k + 1:, k] * x[k]
            for k in range(d - 1, -1, -1):
                x[k] = x[k] / a[k, k]
                x[:k] -= a[:k, k] * x[k]
            return x
        vectors = [np.array([Decimal(((i + 1) * (7919 + 104729 * j)) % 10007 + 1) for i in range(d)], dtype=object) for j in range(many)]
        for _ in range(3):
            basis: list[np.ndarray] = []
            for v in vectors:
                v = solved(v)
                v = v / max(np.abs(v))
                for _ in range(2):
                    for b in basis:
                        v = v - b * (b * v).sum()
                    v = v / (v * v).sum().sqrt()
                basis.append(v)
            vectors = basis
        return [(v if v[int(np.argmax(np.abs(v)))] > 0 else -v).tolist() for v in vectors]


def leading_components(matrix: list[list[int]], count: int, residues: Callable[[list[int]], dict[int, list[int]]]) -> list[tuple[Decimal, list[Decimal]]]:
    """(eigenvalue, unit eigenvector) of the `count` largest positive eigenvalues, falling.

    `residues` gives the characteristic polynomial modulo each of the primes it is given.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    if trace == 0:
        return []
    poly = combined(residues(primes_for(coefficient_bound(trace, d))))
    out = []
    for numerator, scale, many in largest_roots(poly, count):
        with localcontext() as context:
            context.prec = DECIMALS
            root = Decimal(2 * numerator + 1) / Decimal(1 << (scale + 1))
        out.extend((root, v) for v in null_vectors(matrix, root, many))
    return out[:count]
