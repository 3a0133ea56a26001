"""BPE encoding and decoding with a contiguous rank array per short word.

A word's parts sit in one contiguous list next to a list of the ranks of all
adjacent pairs.  Each step scans the ranks for their minimum (the leftmost on
ties), joins that pair by deleting the boundary between its parts, and refreshes
the two neighbouring ranks.  Words beyond ``SHORT_WORD`` bytes use the same
merge order with a heap over linked parts, so no text makes it quadratic.

The vocabulary is read from a tokenizers JSON file (byte-level BPE): its
vocabulary, merges and added tokens.  Nothing is trained and nothing is copied.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from traitmatch.llm.common import map_texts, texts_of

# The pre-tokenisation pattern of byte-level BPE (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The same split for texts of Latin letters (below U+0250, without superscripts, fractions and
# separator controls, whose classes differ between the two regex libraries): about three times as fast.
LATIN = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
LATIN_PATTERN = rf" ?[{LATIN}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s{LATIN}0-9]+|\s+(?!\S)|\s+"
NOT_LATIN = "[^\t-\r -\x7e\x85\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]"

SHORT_WORD = 192          # bytes; longer words take the heap form
CACHED_WORDS = 400_000    # word cache entries per worker, then it starts anew
CACHED_CHARS = 48         # only words up to this length are cached
NONE = 1 << 60            # "this pair has no merge"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself if printable, else the next code point from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in printable:
            out[b] = chr(b)
        else:
            out[b] = chr(extra)
            extra += 1
    return out


class RankBPE:
    """Byte-level BPE over a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") \
                or spec.get("normalizer") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("expected a plain byte-level BPE tokenizer file")
        vocab = model["vocab"]
        symbols = byte_symbols()
        byte_of = {c: b for b, c in enumerate(symbols)}
        self.byte_ids = [vocab[c] for c in symbols]
        added = spec.get("added_tokens", [])
        size = max([*vocab.values(), *(t["id"] for t in added)]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(byte_of[c] for c in token)
        for t in added:
            self.token_bytes[t["id"]] = t["content"].encode()
        # (left id << 32 | right id) -> rank; rank -> id of the joined part
        self.ranks: dict[int, int] = {}
        self.joined: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[left] << 32 | vocab[right]] = rank
            self.joined.append(vocab[left + right])
        self.words, self.latin_words = regex.compile(PATTERN), re.compile(LATIN_PATTERN)
        self.not_latin = re.compile(NOT_LATIN)
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens with matching options are not supported")
        self.added = {t["content"]: t["id"].to_bytes(4, "little") for t in added}
        self.added_split = regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if added else None
        self.cache: dict[str, bytes] = {}

    def merge_short(self, word: bytes) -> list[int]:
        """Token ids of one word by repeated minimum scans over its rank array."""
        ids, ranks, joined = [self.byte_ids[b] for b in word], self.ranks, self.joined
        near = [ranks.get(a << 32 | b, NONE) for a, b in zip(ids, ids[1:])]
        while near:
            best = min(near)
            if best == NONE:
                break
            i = near.index(best)
            ids[i] = joined[best]
            del ids[i + 1], near[i]           # the boundary between parts i and i+1 goes
            if i < len(near):
                near[i] = ranks.get(ids[i] << 32 | ids[i + 1], NONE)
            if i:
                near[i - 1] = ranks.get(ids[i - 1] << 32 | ids[i], NONE)
        return ids

    def merge_long(self, word: bytes) -> list[int]:
        """The same merges for a long word: a heap of (rank, position) over linked parts."""
        ids, n = [self.byte_ids[b] for b in word], len(word)
        after, before, ranks = list(range(1, n + 1)), list(range(-1, n - 1)), self.ranks
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(ids[i] << 32 | ids[i + 1], NONE)) < NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or ranks.get(ids[i] << 32 | ids[j], NONE) != r:
                continue                      # an entry of parts that have changed since
            ids[i], ids[j], after[i] = self.joined[r], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (x := ranks.get(ids[i] << 32 | ids[after[i]], NONE)) < NONE:
                    heapq.heappush(heap, (x, i))
            if (p := before[i]) >= 0 and (x := ranks.get(ids[p] << 32 | ids[i], NONE)) < NONE:
                heapq.heappush(heap, (x, p))
        return [t for t in ids if t >= 0]

    def word_ids(self, word: str) -> bytes:
        raw = word.encode()
        ids = self.merge_short(raw) if len(raw) <= SHORT_WORD else self.merge_long(raw)
        packed = np.asarray(ids, dtype="<u4").tobytes()
        if len(word) <= CACHED_CHARS:
            if len(self.cache) >= CACHED_WORDS:
                self.cache.clear()
            self.cache[word] = packed
        return packed

    def encode_packed(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        get, make = self.cache.get, self.word_ids
        words = (self.words if self.not_latin.search(text) else self.latin_words).findall
        if self.added_split is None or not any(t in text for t in self.added):
            return b"".join([get(w) or make(w) for w in words(text)])
        out = []
        for piece in self.added_split.split(text):
            if piece in self.added:
                out.append(self.added[piece])
            else:
                out.extend([get(w) or make(w) for w in words(piece)])
        return b"".join(out)

    def decode_packed(self, packed: bytes) -> bytes:
        """UTF-8 of the decoded text; byte runs that are not UTF-8 become U+FFFD, ids out of range nothing."""
        table = self.token_bytes
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        raw = b"".join([table[i] for i in ids if i < len(table)])
        return raw.decode("utf-8", "replace").encode()


@lru_cache(maxsize=2)
def tokenizer(path: str) -> RankBPE:
    return RankBPE(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _encoder(path: str, with_ids: bool):
    bpe = tokenizer(path)

    def one(text):
        packed = bpe.encode_packed(text or "")
        decoded = bpe.decode_packed(packed)
        digests = (len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest())
        return (*digests, packed, decoded.decode()) if with_ids else digests

    return one


DIGESTS = [("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]


def encode_documents(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False, hand_back: bool = False) -> DataFrame:
    """Encode and decode every text; one row per input row, repeated rows included.

    ``doc_id, n_tokens, ids_sha256, decoded_sha256``; ``with_ids`` adds ``ids``
    (binary, little-endian unsigned 32-bit) and ``decoded`` (string).  A null or
    empty text has no tokens (the digests are those of nothing); a null id stays
    null; an empty table gives no rows; other columns are ignored.  ``hand_back`` drops the
    tokenizer and its cached words at the end of each task, for one of several stages.
    """
    fields = DIGESTS + ([("ids", "binary"), ("decoded", "string")] if with_ids else [])
    return map_texts(texts_of(docs, id_col, text_col), _encoder, (vocabulary or default_vocabulary(), with_ids),
                     fields, hand_back=hand_back, forget=[tokenizer])
