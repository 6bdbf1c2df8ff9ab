"""Prediction by partial matching over bytes: the trie of contexts, and the code length of texts.

A context is the last `order` symbols; a symbol is a byte or the end of the text (256), and a text begins in a context of ends.
A context with total count N over d distinct symbols gives a known symbol n / (N + d) and escapes with d / (N + d). After an
escape the next shorter context leaves out all symbols of the longer one, from its counts and from its escape. The last level is even
over the symbols that no level has. A longest context that training never met costs nothing: the next shorter one begins.

Training counts strings of order + 1 symbols; all shorter counts are sums of these. What a level says after an escape depends on the
longer context alone, since its symbols are a subset, so it is worked out once per context and texts are scored by lookups.
"""

from __future__ import annotations

import numpy as np

BASE = 257
END = 256


class Lookup:
    """A table of values by 64-bit key with open addressing; `find` is NaN where a key is absent."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, np.nan)
        left, self.probes = np.arange(len(keys)), 0
        while len(left):
            slots = self._slots(keys[left], self.probes)
            free = self.keys[slots] == -1
            tried, places = left[free], slots[free]
            self.keys[places] = keys[tried]  # of several for one slot the last one stays
            won = self.keys[places] == keys[tried]
            self.values[places[won]] = values[tried[won]]
            keep = np.ones(len(left), bool)
            keep[np.flatnonzero(free)[won]] = False
            left = left[keep]
            self.probes += 1

    def _slots(self, keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> self.shift).astype(np.int64) + probe) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), np.nan)
        if not self.probes:
            return out
        slots = self._slots(keys, 0)
        hit = self.keys[slots] == keys
        out[hit] = self.values[slots[hit]]
        left = np.flatnonzero(~hit)
        for probe in range(1, self.probes):
            if not len(left):
                break
            slots = self._slots(keys[left], probe)
            hit = self.keys[slots] == keys[left]
            out[left[hit]] = self.values[slots[hit]]
            left = left[~hit & (self.keys[slots] != -1)]
        return out


def symbols_of(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each after `order` ends and with one end behind; where each text's own symbols begin."""
    lead = bytes(order)
    raw = b"".join([lead + x + b"\0" for x in texts])
    symbols = np.frombuffer(raw, np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + order + 1
    begins = np.cumsum(sizes) - sizes
    for k in range(order):
        symbols[begins + k] = END
    symbols[begins + sizes - 1] = END
    return symbols, begins + order


def codes_of(symbols: np.ndarray, order: int) -> np.ndarray:
    """The string of order + 1 symbols that ends at each place from `order` on, as one number."""
    n = len(symbols) - order
    code = symbols[:n].copy()
    for k in range(1, order + 1):
        code *= BASE
        code += symbols[k : k + n]
    return code


def own_places(begins: np.ndarray, total: int, order: int) -> np.ndarray:
    """True for places, of those from `order` on, that are a text's own symbols and not its lead."""
    own = np.ones(total - order, bool)
    for begin in begins[1:]:
        own[begin - 2 * order : begin - order] = False
    return own


def count_codes(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings of order + 1 symbols of the texts, and their counts."""
    symbols, begins = symbols_of(texts, order)
    return np.unique(codes_of(symbols, order)[own_places(begins, len(symbols), order)], return_counts=True)


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at, values, len(distinct))


def _at(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key, -1 where absent; keys are sorted."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _take(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Values at places, of which -1 stands for none; an empty table gives zeros."""
    return values[at] if len(values) else np.zeros(len(at))


def _log(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log10(x)


class Level:
    """Counts of one order: strings, contexts, and each context's logs as the longest and as the one escaped to."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, longer: Level | None, longer_size: int):
        self.codes, self.counts = codes, counts
        self.contexts, starts = np.unique(codes // BASE, return_index=True)
        totals = np.add.reduceat(counts, starts) if len(starts) else counts
        self.kinds = np.diff(np.append(starts, len(codes)))
        self.log_counts, self.log_top, self.log_kinds = _log(counts), _log(totals + self.kinds), _log(self.kinds)
        self.starts = starts
        if longer is not None:  # what it costs to arrive here from each longer context
            same = counts[_at(codes, longer.codes % longer_size)]
            shared = np.add.reduceat(same, longer.starts) if len(longer.starts) else same
            mine = _at(self.contexts, longer.contexts % (longer_size // BASE))
            new = self.kinds[mine] - longer.kinds
            rest = totals[mine] - shared + new
            longer.log_below, longer.log_escape = _log(rest), np.where(new > 0, _log(new) - _log(np.maximum(rest, 1)), 0.0)


class Model:
    """A trained trie. `codes` and `counts` are of strings of order + 1 symbols, sorted by code.

    Levels 0 and 1 may be handed in (`short`: codes of two symbols and their counts over all training), when `codes` is only the part of the
    trie whose contexts end alike; the part then scores the places of those contexts.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, order: int, short: tuple[np.ndarray, np.ndarray] | None = None):
        self.order, self.levels = order, [None] * (order + 1)
        longer = None
        for j in range(order, -1, -1):
            size = BASE ** (j + 1)
            if j == order:
                own = codes, counts.astype(np.float64)
            elif j <= 1 and short is not None:
                own = _sums(short[0] % size, short[1])
            else:
                own = _sums(codes % size, counts)
            self.levels[j] = longer = Level(*own, longer, size)
        self.log_last = -_log(np.array([max(1.0, BASE - len(self.levels[0].codes))]))[0]
        self._index()

    def _index(self) -> None:
        """The table of strings that the longest context knows, which most places need alone."""
        top = self.levels[self.order]
        place = _at(top.contexts, top.codes // BASE)
        self.known = Lookup(top.codes, top.log_counts - top.log_top[place])

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "known"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._index()

    def _rare(self, codes: np.ndarray) -> np.ndarray:
        out, n = np.zeros(len(codes)), len(codes)
        live, came = np.arange(n), np.full(n, -1)  # came: index of the context of the level above, -1 at the longest
        for j in range(self.order, -1, -1):
            if not len(live):
                return out
            level, code = self.levels[j], codes[live] % BASE ** (j + 1)
            context, string = _at(level.contexts, code // BASE), _at(level.codes, code)
            below = _take(level.log_top, context)
            escape = _take(level.log_kinds, context) - below
            if j < self.order:
                above, longest = self.levels[j + 1], came < 0
                below = np.where(longest, below, _take(above.log_below, came))
                escape = np.where(longest, escape, _take(above.log_escape, came))
            found, seen = string >= 0, context >= 0
            out[live[found]] += _take(level.log_counts, string[found]) - below[found]
            missed = seen & ~found
            out[live[missed]] += escape[missed]
            live, came = live[~found], np.where(seen, context, -1)[~found]
        out[live] += self.log_last
        return out

    def log10(self, texts: list[bytes], contexts: tuple[int, int] | None = None, chunk: int = 1 << 20) -> np.ndarray:
        """Log probability of each text; with `contexts`, of its places whose last two context symbols lie in the range."""
        symbols, begins = symbols_of(texts, self.order)
        scores = np.zeros(len(symbols))
        for at in range(0, len(symbols) - self.order, chunk):
            codes = codes_of(symbols[at : at + chunk + self.order], self.order)
            found = self.known.find(codes)
            rare = np.flatnonzero(np.isnan(found))
            found[rare] = self._rare(codes[rare])
            if contexts is not None:
                group = codes // BASE % BASE**2
                found[(group < contexts[0]) | (group >= contexts[1])] = 0.0
            scores[at + self.order : at + self.order + len(found)] = found
        for k in range(1, self.order + 1):
            scores[begins - k] = 0.0
        return np.add.reduceat(scores, begins - self.order) if len(begins) else np.zeros(0)
