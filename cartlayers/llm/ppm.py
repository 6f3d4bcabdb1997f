"""Prediction by partial matching over bytes.

Escape estimation is method C: in a context seen n times with d different symbols, symbol s has
probability c(s) / (n + d) and the escape d / (n + d). After an escape the next shorter context
excludes every symbol of the longer one. Below the empty context, the symbols never seen are equally
likely.

`ByteTrie` is the plain form: it learns and scores symbol by symbol, so it also scores adaptively.
`Model` holds a trie with fixed counts as arrays and scores many texts at once.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np

from cartlayers.llm.tables import hash_table, look_up

ORDER = 5
#: Starts (ORDER times, as context only) and ends (once, scored) every text; never inside a word.
EDGE = 0x0A
SYMBOLS = 256
_BYTE = np.uint64(8)


class ByteTrie:
    """Counts of symbols after contexts of up to ORDER bytes."""

    def __init__(self, order: int = ORDER):
        self.order = order
        self.counts: dict[bytes, dict[int, int]] = defaultdict(dict)

    def learn(self, context: bytes, symbol: int) -> None:
        for o in range(self.order + 1):
            after = self.counts[context[len(context) - o :]]
            after[symbol] = after.get(symbol, 0) + 1

    def log10(self, context: bytes, symbol: int) -> float:
        total, excluded = 0.0, set()
        for o in range(self.order, -1, -1):
            after = self.counts.get(context[len(context) - o :])
            if not after:
                continue
            free = {s: c for s, c in after.items() if s not in excluded}
            if free:
                whole = sum(free.values()) + len(free)
                if symbol in free:
                    return total + math.log10(free[symbol] / whole)
                total += math.log10(len(free) / whole)
            excluded |= after.keys()
        return total - math.log10(SYMBOLS - len(excluded))

    def score(self, text: bytes, adapt: bool) -> float:
        """log10 probability of the text and its end; `adapt` learns each symbol after scoring it."""
        padded, total = bytes([EDGE] * self.order) + text + bytes([EDGE]), 0.0
        for i in range(self.order, len(padded)):
            context, symbol = padded[i - self.order : i], padded[i]
            total += self.log10(context, symbol)
            if adapt:
                self.learn(context, symbol)
        return total


def grams(padded: np.ndarray) -> np.ndarray:
    """For every byte after the first ORDER ones: it and the ORDER bytes before, the byte itself last."""
    n = len(padded) - ORDER
    codes = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(ORDER + 1):
        codes = codes << _BYTE | padded[j : n + j].astype(np.uint64)
    return codes


class Model:
    """Scores grams with fixed counts. Built once from all counts; tasks map its arrays into memory."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays

    @staticmethod
    def build(codes: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        """Arrays of the model, from distinct grams and how often each occurs."""
        arrays: dict[str, np.ndarray] = {}
        longer = None
        for order in range(ORDER, -1, -1):
            codes, back = np.unique(codes & np.uint64((1 << 8 * (order + 1)) - 1), return_inverse=True)
            counts = np.bincount(back, weights=counts, minlength=len(codes)).astype(np.int64)
            context, of = np.unique(codes >> _BYTE, return_inverse=True)
            total = np.bincount(of, weights=counts, minlength=len(context))
            distinct = np.bincount(of, minlength=len(context))
            if longer is not None:
                # what is left here for each longer context, once its symbols are excluded
                up_codes, up_context, up_of = longer
                keep = np.uint64((1 << 8 * order) - 1)
                parent = np.searchsorted(context, up_context & keep)
                symbol = up_codes & np.uint64(255)
                same = np.searchsorted(codes, context[parent][up_of] << _BYTE | symbol)
                taken = np.bincount(up_of, weights=counts[same], minlength=len(up_context))
                arrays[f"free_{order + 1}"] = total[parent] - taken
                arrays[f"kinds_{order + 1}"] = distinct[parent] - np.bincount(up_of, minlength=len(up_context))
            arrays |= {f"contexts_{order}": context, f"total_{order}": total, f"distinct_{order}": distinct}
            if order < ORDER:
                arrays |= {f"codes_{order}": codes, f"counts_{order}": counts}
            elif len(codes):
                value = np.log10(counts / (total + distinct)[of])
                arrays["places"], arrays["values"] = hash_table(codes, value)
            longer = (codes, context, of)
        whole = {k: a for k, a in arrays.items() if a.dtype == np.int64}
        return arrays | {k: a.astype(np.min_scalar_type(int(a.max(initial=0)))) for k, a in whole.items()}

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of the last byte of each gram after the others."""
        a = self.arrays
        if "places" not in a:
            return np.full(len(codes), -math.log10(SYMBOLS))
        found, known = look_up(a["places"], a["values"], codes)
        rest = np.flatnonzero(~known)
        if len(rest):
            distinct, back = np.unique(codes[rest], return_inverse=True)
            found[rest] = self._backed_off(distinct)[back]
        return found

    def _backed_off(self, codes: np.ndarray) -> np.ndarray:
        """As log10, for grams whose longest form was never seen."""
        a = self.arrays
        score = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        # what the present context leaves for the next shorter one; NaN as long as no context was seen
        free = np.full(len(codes), np.nan)
        kinds = np.zeros(len(codes))
        for order in range(ORDER, -1, -1):
            own = codes[open_] & np.uint64((1 << 8 * (order + 1)) - 1)
            context = own >> _BYTE
            at = np.minimum(np.searchsorted(a[f"contexts_{order}"], context), len(a[f"contexts_{order}"]) - 1)
            there = a[f"contexts_{order}"][at] == context
            hit, count = np.zeros(len(own), dtype=bool), np.zeros(len(own))
            if order < ORDER:
                symbol_at = np.minimum(np.searchsorted(a[f"codes_{order}"], own), len(a[f"codes_{order}"]) - 1)
                hit, count = a[f"codes_{order}"][symbol_at] == own, a[f"counts_{order}"][symbol_at].astype(np.float64)
            first = np.isnan(free[open_])
            left = np.where(first, a[f"total_{order}"][at].astype(np.float64), free[open_])
            sorts = np.where(first, a[f"distinct_{order}"][at].astype(np.float64), kinds[open_])
            with np.errstate(divide="ignore", invalid="ignore"):
                score[open_] += np.where(hit, np.log10(count / (left + sorts)), 0.0)
                gone = there & ~hit & (sorts > 0)
                score[open_] += np.where(gone, np.log10(sorts / (left + sorts)), 0.0)
            if order:
                free[open_] = np.where(there, a[f"free_{order}"][at], np.nan)
                kinds[open_] = np.where(there, a[f"kinds_{order}"][at], 0)
            open_ = open_[~hit]
        score[open_] -= math.log10(max(1, SYMBOLS - len(a["codes_0"])))
        return score
