"""Vectorised lookup of variable-length byte contexts.

A set of contexts (byte strings) becomes integer tables, so the longest known
suffix before every byte of a long array is found by a few array gathers: one
dense table over the last three symbols, and one step of a prefix tree for each
further symbol of the longer contexts.
"""

from __future__ import annotations

import numpy as np

PAD = b"\n" * 8            # what stands before a text's first byte; contexts are shorter


class ContextTable:
    """Contexts over an alphabet of the bytes that occur in training, plus one symbol for all others."""

    def __init__(self, alphabet: bytes, contexts: list[bytes]):
        self.bytes_of = [*sorted(set(alphabet))]
        self.size = a = len(self.bytes_of) + (len(self.bytes_of) < 256)
        self.symbol = np.full(256, a - 1, np.int32)
        self.symbol[self.bytes_of] = np.arange(len(self.bytes_of), dtype=np.int32)
        self.contexts = sorted({b"", *contexts}, key=lambda c: (len(c), c))
        self.depth = len(self.contexts[-1])
        if self.depth > len(PAD):
            raise ValueError(f"contexts of more than {len(PAD)} bytes")
        # dense[s3, s2, s1]: number of the longest context of up to three symbols
        dense = np.zeros((a, a, a), np.int32)
        nodes: dict[bytes, int] = {}              # proper prefixes and whole long contexts, 0 is dead
        for i, c in enumerate(self.contexts):
            s = self.symbol[np.frombuffer(c, np.uint8)]
            if len(c) == 1:
                dense[:, :, s[0]] = i
            elif len(c) == 2:
                dense[:, s[0], s[1]] = i
            elif len(c) == 3:
                dense[s[0], s[1], s[2]] = i
            else:
                for k in range(3, len(c) + 1):
                    nodes.setdefault(c[:k], len(nodes) + 1)
        self.dense = dense.reshape(-1)
        if self.depth > 3:
            self.first = np.zeros(a * a * a, np.int32)
            step = np.zeros((len(nodes) + 1, a), np.int32)
            self.number = np.zeros(len(nodes) + 1, np.int32)
            numbers = {c: i for i, c in enumerate(self.contexts)}
            for c, node in nodes.items():
                s = [int(x) for x in self.symbol[np.frombuffer(c, np.uint8)]]
                if len(c) == 3:
                    self.first[(s[0] * a + s[1]) * a + s[2]] = node
                else:
                    step[nodes[c[:-1]], s[-1]] = node
                    self.number[node] = numbers.get(c, 0)
            self.step = step.reshape(-1)

    def states(self, symbols: np.ndarray) -> np.ndarray:
        """For each position from ``len(PAD)`` on, the number of the longest context of the bytes before it."""
        a, s, n, p = self.size, symbols, len(symbols), len(PAD)
        triple = (s[:-3] * a + s[1:-2]) * a + s[2:-1]        # entry i: symbols i..i+2
        state = self.dense[triple[p - 3:]]
        if self.depth > 3:
            node = self.first[triple]                        # entry i: node of symbols i..i+k-1
            for k in range(4, self.depth + 1):
                node = self.step[node[:n - k] * a + s[k - 1:n - 1]]
                longer = self.number[node[p - k:]]
                state = np.where(longer > 0, longer, state)
        return state
