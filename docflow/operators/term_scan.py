"""Which of many texts contain any of many terms: the terms as tables of 64-bit words, every place of a batch of
texts looked up in them with numpy.

Up to eight characters from a place make one word, so a term of up to eight characters is found by equality.
Of a longer term eight characters are looked up, those that the fewest terms share, and where they stand the rest is
compared word by word. Nothing is decided by a hash alone: a bitmap of hashes only keeps most places from
the exact look-up.
"""

from __future__ import annotations

import numpy as np

WORD = 8
CHUNK = 1 << 16  # places looked up at once: their words stay in a core's cache
END = 10  # the byte after every text; no term holds it
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _words(buf: np.ndarray, begin: int, n: int) -> np.ndarray:
    """The eight bytes from each of ``n`` places on as a number; ``buf`` goes on for 16 bytes after the last."""
    out = np.empty(-(-n // WORD) * WORD, "<u8")
    for s in range(WORD):
        out[s::WORD] = np.frombuffer(buf, "<u8", out.size // WORD, begin + s)
    return out[:n]


def _mask(n: int) -> np.uint64:
    return np.uint64((1 << (8 * n)) - 1)


class _Table:
    """Sorted distinct words, with a bitmap of their hashes before the exact look-up."""

    def __init__(self, words: np.ndarray):
        self.words = np.unique(words)
        bits = min(24, max(12, int(self.words.size).bit_length() + 5))
        self.shift = np.uint64(64 - bits)
        self.bitmap = np.zeros(1 << bits, bool)
        self.bitmap[(self.words * _MIX) >> self.shift] = True

    def find(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``at`` that hold a word of the table, and which one."""
        if self.words.size == 1:
            places = np.flatnonzero(at == self.words[0])
            return places, np.zeros(places.size, np.int64)
        places = np.flatnonzero(self.bitmap[(at * _MIX) >> self.shift])
        found = np.searchsorted(self.words, at[places])
        same = self.words[np.minimum(found, self.words.size - 1)] == at[places]
        return places[same], found[same]


class TermScan:
    """``terms``: distinct folded terms (ASCII), none of them empty."""

    def __init__(self, terms: list[bytes]):
        self.short = []  # (mask, table): terms of one length below eight
        for n in range(1, WORD):
            words = [int.from_bytes(t, "little") for t in terms if len(t) == n]
            if words:
                self.short.append((_mask(n), _Table(np.array(words, "<u8"))))
        long = sorted(t for t in terms if len(t) >= WORD)
        self.table = None
        if not long:
            return
        size = np.array([len(t) for t in long], np.int64)
        flat = np.frombuffer(b"".join(long) + b"\0" * 2 * WORD, np.uint8)
        begin = np.cumsum(size) - size
        # the place in each term whose word the fewest places of all terms hold
        words = _words(flat, 0, int(size.sum()))
        term = np.repeat(np.arange(size.size), size)
        at = np.arange(words.size) - begin[term]
        whole = at <= size[term] - WORD
        words, term, at = words[whole], term[whole], at[whole]
        _, which, count = np.unique(words, return_inverse=True, return_counts=True)
        order = np.lexsort((at, count[which], term))
        first = order[np.unique(term[order], return_index=True)[1]]
        probe, self.at = words[first], at[first]
        self.table = _Table(probe)
        slot = np.searchsorted(self.table.words, probe)
        # terms by the slot of their probe; a term of eight characters is its probe
        self.by_slot = np.argsort(slot, kind="stable")
        self.ends = np.cumsum(np.bincount(slot, minlength=self.table.words.size))
        self.exact = np.zeros(self.table.words.size, bool)
        self.exact[slot[size == WORD]] = True
        # the words of each term end to end, the last one padded
        self.size, n_words = size, -(-size // WORD)
        self.word_at = np.cumsum(n_words) - n_words
        padded = np.zeros(int(n_words.sum()) * WORD, np.uint8)
        padded[np.repeat(self.word_at * WORD - begin, size) + np.arange(int(size.sum()))] = flat[: int(size.sum())]
        self.term_words = padded.view("<u8")

    def _verified(self, buf: np.ndarray, n: int, places: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Those of ``places`` (where the probe of a slot stands) at which a term of the slot stands whole."""
        ends = self.ends[slots]
        count = ends - np.where(slots > 0, self.ends[slots - 1], 0)
        pair = np.repeat(np.arange(places.size), count)
        nth = np.arange(pair.size) - np.repeat(np.cumsum(count) - count, count)
        term = self.by_slot[(ends - count)[pair] + nth]
        begin = places[pair] - self.at[term]
        left = np.flatnonzero((begin >= 0) & (begin + self.size[term] <= n))
        out, k = [], 0
        view = np.lib.stride_tricks.sliding_window_view(buf, WORD)
        while left.size:
            t = term[left]
            rest = self.size[t] - k * WORD
            got = view[begin[left] + k * WORD].view("<u8")[:, 0]
            keep = np.where(rest >= WORD, ~np.uint64(0), (np.uint64(1) << (np.minimum(rest, WORD - 1) * 8).astype(np.uint64)) - np.uint64(1))
            same = (got & keep) == self.term_words[self.word_at[t] + k]
            done = same & (rest <= WORD)
            out.append(pair[left[done]])
            left, k = left[same & ~done], k + 1
        return places[np.unique(np.concatenate(out))] if out else places[:0]

    def matches(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether each text holds a term. ``data`` has the bytes of the texts end to end, each followed by ``END``;
        ``ends`` says where each is over, that byte included."""
        n = data.size
        buf = np.zeros(n + 3 * WORD, np.uint8)
        buf[:n] = data
        hit = np.zeros(ends.size, bool)
        for begin in range(0, n, CHUNK):
            words = _words(buf, begin, min(CHUNK, n - begin))
            for mask, table in self.short:
                places, _ = table.find(words & mask)
                hit[np.searchsorted(ends, places + begin, "right")] = True
            if self.table is not None:
                places, slots = self.table.find(words)
                text = np.searchsorted(ends, places + begin, "right")
                hit[text[self.exact[slots]]] = True
                open_ = ~hit[text]
                if open_.any():
                    held = self._verified(buf, n, places[open_] + begin, slots[open_])
                    hit[np.searchsorted(ends, held, "right")] = True
        return hit
