"""Quality rules: base word rules plus compression bands.

A document's zstandard ratio (bytes / compressed bytes) is held against limits
for its length, over the whole text and over fixed chunks.  Repetitive text lies
above the band, incompressible text (random strings, base64) below it.  Hex digits
compress as well as short clean texts do (1.5 to 1.95), so text made of hex words is
told by its words instead.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitmatch.llm.common import map_texts, texts_of

LEVEL = 3
CHUNK = 4096
# (least bytes, lowest ratio, highest ratio); texts below the first length are not judged by ratio.
# The lowest ratios lie between those of base64 (lines or words: up to 1.21, 1.29, 1.31, 1.34 and 1.36
# at the end of each step) and the least of clean test texts (1.34, 1.43, 1.69, 1.92, 2.09, 2.21, 2.39).
BANDS = ((256, 1.22, 3.0), (512, 1.32, 3.3), (1024, 1.38, 3.6), (2048, 1.42, 4.0), (4096, 1.45, 4.5),
         (8192, 1.45, 5.0), (32768, 1.45, 6.0))
HEX_WORD = re.compile(rb"[0-9a-f]+|[0-9A-F]+")
HEX_SHARE, MIXED_SHARE = 0.5, 0.25     # of the word bytes: in hex words, and in those with digits and letters
MAX_BAD_CHUNKS = 0.5       # rejected if more than this share of the chunk bytes lies outside its band
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"

FIELDS = [("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"),
          ("n_repeat_words", "bigint"), ("base_failed", "boolean"), ("kept", "boolean"), ("ratio", "double"),
          ("bad_chunk_share", "double")]


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    # window numbers: pairs first, so that the code of a triple cannot overflow
    _, pairs = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)
    _, at, times = np.unique(pairs[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
    hit = times[at] >= 2
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= hit
    return int(covered.sum())


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def base_counts(text: str) -> tuple[int, int, int, int, int, bool]:
    words = text.encode().split()            # bytes.split() cuts at exactly \x20 and \x09-\x0D
    n, repeated = len(words), repeat_words(words)
    word_chars = len(text) - sum(text.count(c) for c in BLANKS)
    return (n, word_chars, sum(text.count(c) for c in SYMBOLS), dup_lines(text), repeated,
            n < 50 or 100 * repeated > 50 * n)


def band(n_bytes: int) -> tuple[float, float] | None:
    found = None
    for least, low, high in BANDS:
        if n_bytes >= least:
            found = (low, high)
    return found


@lru_cache(maxsize=1)
def compressor():
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL)


def ratio(raw: bytes) -> float:
    return len(raw) / len(compressor().compress(raw))


def outside(raw: bytes) -> bool:
    limits = band(len(raw))
    return limits is not None and not limits[0] <= ratio(raw) <= limits[1] or hex_text(raw)


def hex_text(raw: bytes) -> bool:
    """Whether most of the text is hex words, with digits and letters mixed as in random ones."""
    words = raw.split()
    total = sum(map(len, words))
    found = [w for w in words if HEX_WORD.fullmatch(w)]
    mixed = sum(len(w) for w in found if not w.isdigit() and not w.isalpha())
    return sum(map(len, found)) > HEX_SHARE * total and mixed > MIXED_SHARE * total


def judge(raw: bytes, chunk: int = CHUNK) -> tuple[float, float, bool]:
    """Whole ratio, share of chunk bytes outside their band, and whether the text passes."""
    if not raw:
        return 0.0, 0.0, False
    whole, limits = ratio(raw), band(len(raw))
    bad = sum(len(part) for i in range(0, len(raw), chunk) if outside(part := raw[i:i + chunk])) / len(raw) \
        if len(raw) > chunk else 0.0
    fits = (limits is None or limits[0] <= whole <= limits[1]) and not hex_text(raw)
    return whole, bad, fits and bad <= MAX_BAD_CHUNKS


def _rules():
    def one(text):
        text = text or ""
        counts = base_counts(text)
        whole, bad, passes = judge(text.encode())
        return (*counts, not counts[-1] and passes, whole, bad)

    return one


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rule counts and verdict of every whole text, one row per input row.

    A null or empty text has no words and fails; repeated rows each get their
    row; a null id stays null; an empty table gives no rows; other columns are
    ignored.
    """
    return map_texts(texts_of(docs, id_col, text_col), _rules, (), FIELDS)


def _verdict():
    one = _rules()
    return lambda text: (text, one(text)[6])


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text passes, all columns unchanged; every row is judged by its own text in one scan.

    A null or empty text has no words and goes; repeated rows go or stay alike; an
    empty table gives no rows.
    """
    names = docs.columns
    at = names.index(text_col)
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    made = map_texts(plain, _verdict, (), [("_text", "string"), ("_kept", "boolean")], text_at=at, hand_back=True)
    return made.filter("_kept").select(*[F.col("_text" if i == at else f"_c{i}").alias(n)
                                         for i, n in enumerate(names)])
