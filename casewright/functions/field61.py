"""Arithmetic in the field of 2**61 - 1 elements: vectors with numpy, small polynomials with Python integers."""

from __future__ import annotations

P = (1 << 61) - 1


def mul(a, b):
    """Element-wise product of two uint64 arrays of reduced values."""
    import numpy as np

    low, thirty = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
    a1, a0, b1, b0 = a >> np.uint64(31), a & low, b >> np.uint64(31), b & low
    mid = a1 * b0 + a0 * b1
    x = np.uint64(2) * (a1 * b1) + (mid >> np.uint64(30)) + ((mid & thirty) << np.uint64(31)) + a0 * b0
    return reduce(x)


def reduce(x):
    """Values below 2**64 brought below P."""
    import numpy as np

    p = np.uint64(P)
    x = (x & p) + (x >> np.uint64(61))
    return np.where(x >= p, x - p, x)


def products(group, values):
    """Product of the rows of values (rows by points) for each run of equal, sorted group numbers: (groups, products).

    Neighbours are multiplied in pairs, so the passes are the logarithm of the longest run.
    """
    import numpy as np

    while True:
        new = np.append(True, group[1:] != group[:-1])
        if new.all():
            return group, values
        first = np.flatnonzero(new)
        rank = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
        left = np.flatnonzero(rank % 2 == 0)
        right = left + 1
        paired = (right < len(group)) & (rank[np.minimum(right, len(group) - 1)] % 2 == 1)
        out = values[left]
        out[paired] = mul(out[paired], values[right[paired]])
        group, values = group[left], out


def solve(rows: list[list[int]]) -> list[int] | None:
    """A solution of a linear system (rows with the right side last); free unknowns are 0; None if there is none."""
    n, m = len(rows), len(rows[0]) - 1
    pivots, r = [], 0
    for c in range(m):
        k = next((i for i in range(r, n) if rows[i][c]), None)
        if k is None:
            continue
        rows[r], rows[k] = rows[k], rows[r]
        inv = pow(rows[r][c], -1, P)
        rows[r] = [x * inv % P for x in rows[r]]
        for i in range(n):
            if i != r and (f := rows[i][c]):
                rows[i] = [(x - f * y) % P for x, y in zip(rows[i], rows[r], strict=True)]
        pivots.append(c)
        r += 1
    if any(row[m] for row in rows[r:]):
        return None
    out = [0] * m
    for i, c in enumerate(pivots):
        out[c] = rows[i][m]
    return out


def value(poly: list[int], x: int) -> int:
    """Value of a polynomial, lowest coefficient first."""
    out = 0
    for c in reversed(poly):
        out = (out * x + c) % P
    return out


def _divide(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    a, q = a[:], [0] * max(1, len(a) - len(b) + 1)
    inv = pow(b[-1], -1, P)
    for i in range(len(a) - len(b), -1, -1):
        q[i] = f = a[i + len(b) - 1] * inv % P
        if f:
            for j, y in enumerate(b):
                a[i + j] = (a[i + j] - f * y) % P
    while a and not a[-1]:
        a.pop()
    return q, a


def reduced(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Both polynomials without their common divisor."""
    x, y = a, b
    while y:
        x, y = y, _divide(x, y)[1]
    return (_divide(a, x)[0], _divide(b, x)[0]) if len(x) > 1 else (a, b)


def rational(points: list[int], ratios: list[int], surplus: int, bound: int) -> tuple[list[int], list[int]] | None:
    """Monic polynomials whose quotient has the given values and whose degrees differ by surplus and add up to at most
    bound; None if the points beyond the first `bound` do not confirm it."""
    bound -= (bound - surplus) % 2
    if abs(surplus) > bound:
        return None
    up, down = (bound + surplus) // 2, (bound - surplus) // 2
    rows = []
    for z, f in zip(points[:bound], ratios[:bound], strict=True):
        powers = [1]
        for _ in range(max(up, down)):
            powers.append(powers[-1] * z % P)
        rows.append([*powers[:up], *[-f * x % P for x in powers[:down]], (f * powers[down] - powers[up]) % P])
    found = solve(rows) if bound else []
    if found is None:
        return None
    a, b = [*found[:up], 1], [*found[up:], 1]
    if any(value(a, z) != f * value(b, z) % P for z, f in zip(points[bound:], ratios[bound:], strict=True)):
        return None
    return reduced(a, b)
