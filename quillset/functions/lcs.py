"""Longest common subsequence of token lists, the one measure Spark has no expression for."""

from __future__ import annotations

import math
from collections import Counter


#: Tokens with more places than this keep their bit mask, which is as long as the text; others build it when it is needed.
FEW_PLACES = 32


class _Table:
    """The table of LCS sizes of a reference, row by row.

    A row is one bit vector per candidate prefix; its zero bits mark where the LCS grows along the reference.
    Bit-parallel dynamic programming (Hyyro 2004): the next row costs one big-integer addition.
    """

    def __init__(self, reference):
        self.places: dict[str, list[int]] = {}
        for i, token in enumerate(reference):
            self.places.setdefault(token, []).append(i)
        self.masks = {t: self._mask(p) for t, p in self.places.items() if len(p) > FEW_PLACES}
        self.first = (1 << len(reference)) - 1

    @staticmethod
    def _mask(places: list[int]) -> int:
        bits = bytearray(places[-1] // 8 + 1)
        for i in places:
            bits[i >> 3] |= 1 << (i & 7)
        return int.from_bytes(bits, "little")

    def after(self, row: int, token) -> int:
        places = self.places.get(token)
        if places is None:
            return row
        hit = row & (self.masks[token] if len(places) > FEW_PLACES else self._mask(places))
        return ((row + hit) | (row - hit)) & self.first


def lcs_size(reference, candidate) -> int:
    """The size of the longest common subsequence; one row is held at a time."""
    table = _Table(reference)
    row = table.first
    for token in candidate:
        row = table.after(row, token)
    return len(reference) - row.bit_count()


def lcs_positions(reference, candidate, table: _Table | None = None) -> set[int]:
    """Reference positions of one LCS, traced from the end, preferring to step back in the reference.

    ``table`` may be that of the reference, made before. Of candidate tokens in a row that the reference lacks one stands
    for all, as the trace steps over the others where it is.

    Of the rows only about the root of their number is kept; those between two kept ones are computed again when the
    trace comes to them, so memory grows with the root of the candidate and time doubles.
    """
    table = table or _Table(reference)
    some, candidate = candidate, []
    for token in some:
        if token in table.places:
            candidate.append(token)
        elif not candidate or candidate[-1] is not None:
            candidate.append(None)
    step = math.isqrt(len(candidate)) + 1
    row, kept = table.first, [table.first]
    for n, token in enumerate(candidate, 1):
        row = table.after(row, token)
        if n % step == 0:
            kept.append(row)
    i, j, found, rows, base = len(reference), len(candidate), set(), [], len(candidate) + 1

    def size(i: int, j: int) -> int:
        return i - (rows[j - base] & ((1 << i) - 1)).bit_count()

    while i and j:
        if j - 1 < base:
            base = (j - 1) // step * step
            rows = [kept[base // step]]
            for token in candidate[base:j]:
                rows.append(table.after(rows[-1], token))
        if reference[i - 1] == candidate[j - 1]:
            i, j = i - 1, j - 1
            found.add(i)
        elif not rows[j - base] >> (i - 1) & 1 and size(i, j - 1) == size(i, j):  # that is, > size(i - 1, j)
            j -= 1
        else:
            i -= 1
    return found


def union_lcs_hits(reference_lines, candidate_lines) -> int:
    """Tokens of the reference lines covered by any candidate line, no token counted more often than
    either side holds it."""
    left = Counter(t for line in reference_lines for t in line)
    left &= Counter(t for line in candidate_lines for t in line)
    hits = 0
    for line in reference_lines:
        table = _Table(line)
        found = [lcs_positions(line, other, table) for other in candidate_lines if not table.places.keys().isdisjoint(other)]
        for position in sorted(set().union(*found)):
            if left[line[position]] > 0:
                left[line[position]] -= 1
                hits += 1
    return hits
