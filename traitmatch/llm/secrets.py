"""Secret scans: fixed patterns plus a token-efficiency test.

Ordinary words cost few tokens a character under a large public vocabulary;
random strings cost many.  Runs of key characters with a low characters-per-token
ratio are reported as kind ``random``, after known digests and identifiers are
excluded: an identifier is what has the form of one and is made of words that cost few tokens.  A path or a name joined to a key raises the ratio of the whole run, so
its parts without words, digests and UUIDs are tested too, then the costliest
stretch of each.  The fixed patterns (``assign``, ``access``, ``hex``) are always reported.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitmatch.llm.common import map_texts, texts_of

# Fixed patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")          # a maximal run of 24 or more
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")

LEAST = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
PART = re.compile(r"[A-Za-z0-9]+")
WORD = 4                                    # an identifier of so many characters ends a stretch; a shorter one may lie in a key
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)  # md5, sha1, sha224, sha256, sha384, sha512 in hex
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
UUID_PART = re.compile(rf"(?<![A-Za-z0-9]){UUID.pattern}(?![A-Za-z0-9])")
# Identifiers: words of one case style, or digits, joined by separators.  A run of separators is
# taken whole (possessive), so a long one cannot be cut in exponentially many ways.
IDENTIFIER = re.compile(r"([a-z]+|[A-Z]+|([A-Z][a-z]{2,})+|[a-z]+([A-Z][a-z]{2,})+|[0-9]+)?"
                        r"([-_/+=]++([a-z]+|[A-Z]+|([A-Z][a-z]{2,})+|[a-z]+([A-Z][a-z]{2,})+|[0-9]+)?)*")
LETTERS = re.compile(r"[A-Za-z]+")
MAX_CHARS_PER_TOKEN = 2.0
# The ratio of a very long run is read from pieces of this size, so the test stays linear.
PIECE = 4096


@lru_cache(maxsize=2)
def vocabulary(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def is_digest(run: str) -> bool:
    return len(run) in DIGEST_LENGTHS and bool(DIGEST.fullmatch(run))


def is_identifier(run: str, encoding, limit: float) -> bool:
    """Whether a run has the form of an identifier and its words, apart from its numbers, cost few tokens:
    all together, and each that is long enough for a key.

    The form alone proves nothing: a random key of one letter case has it too.
    """
    if not IDENTIFIER.fullmatch(run):
        return False
    words = LETTERS.findall(run)
    tokens = [sum(len(encoding.encode_ordinary(w[i:i + PIECE])) for i in range(0, len(w), PIECE)) for w in words]
    return (not words or sum(map(len, words)) > limit * sum(tokens)
            and all(len(w) < LEAST or len(w) > limit * n for w, n in zip(words, tokens)))


def excluded(run: str, encoding, limit: float = MAX_CHARS_PER_TOKEN) -> bool:
    """Whether a run is a known digest or an identifier, or beside digests and UUIDs holds no more than an identifier or a few characters."""
    if is_digest(run) or is_identifier(run, encoding, limit):
        return True
    rest = UUID_PART.sub("", run)
    rest = PART.sub(lambda m: "" if is_digest(m[0]) else m[0], rest)
    return len(rest) < len(run) and (len(rest) < LEAST or is_identifier(rest, encoding, limit))


def token_lengths(run: str, encoding) -> list[int]:
    return [len(encoding.decode_single_token_bytes(t)) for i in range(0, len(run), PIECE)
            for t in encoding.encode_ordinary(run[i:i + PIECE])]


def chars_per_token(run: str, encoding) -> float:
    tokens = sum(len(encoding.encode_ordinary(run[i:i + PIECE])) for i in range(0, len(run), PIECE))
    return len(run) / max(1, tokens)


def stretches(run: str, encoding, limit: float) -> list[tuple[int, int]]:
    """Bounds of the longest stretches of parts without a word, digest or UUID, of ``LEAST`` characters or more."""
    known = [m.span() for m in UUID_PART.finditer(run)]
    out, start, end, at = [], None, 0, 0
    for m in PART.finditer(run):
        while at < len(known) and known[at][1] <= m.start():
            at += 1
        if (at < len(known) and known[at][0] <= m.start() or is_digest(m[0])
                or len(m[0]) >= WORD and is_identifier(m[0], encoding, limit)):
            out.append((start, end))
            start = None
        else:
            start, end = m.start() if start is None else start, m.end()
            while run[end:end + 1] == "=":          # padding of base64
                end += 1
    out.append((start, end))
    return [(a, b) for a, b in out if a is not None and b - a >= LEAST and not excluded(run[a:b], encoding, limit)]


def costly(run: str, encoding, limit: float) -> list[tuple[int, int]]:
    """Bounds of disjoint stretches of tokens, ``LEAST`` characters or more, of a ratio of at most ``limit``.

    A stretch begins where the spare (``limit`` a token, less its characters) is
    positive and ends at its highest sum; what follows begins anew once the sum is
    used up.  Each token is passed once or, after a stretch's end, twice.
    """
    out, at, start, best, end, spare = [], 0, 0, 0.0, 0, 0.0
    for n in token_lengths(run, encoding):
        if spare <= 0:
            if end - start >= LEAST:
                out.append((start, end))
            start, end, spare, best = at, at, 0.0, 0.0
        at += n
        spare += limit - n
        # the furthest end whose stretch still keeps to the limit, while it has not fallen far from its best
        if spare >= best or end - start < LEAST and spare >= 0:
            best, end = max(best, spare), at
    if end - start >= LEAST:
        out.append((start, end))
    return [(a, b) for a, b in out if not excluded(run[a:b], encoding, limit)]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the fixed patterns, in code points, end exclusive."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def random_spans(text: str, encoding, limit: float = MAX_CHARS_PER_TOKEN) -> list[tuple[int, int, int]]:
    """Runs of 20 or more key characters whose characters-per-token ratio is at most ``limit``.

    Where a run exceeds it, its stretches between words, digests and UUIDs that keep
    to it, or else the costliest stretches within these.
    """
    out = []
    for m in CANDIDATE.finditer(text):
        if excluded(m[0], encoding, limit):
            continue
        if chars_per_token(m[0], encoding) <= limit:
            out.append((m.start(), 3, m.end()))
            continue
        for a, b in stretches(m[0], encoding, limit):
            part = m[0][a:b]
            found = [(0, len(part))] if chars_per_token(part, encoding) <= limit else costly(part, encoding, limit)
            out += [(m.start() + a + x, 3, m.start() + a + y) for x, y in found]
    return out


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_text(text: str | None, encoding, limit: float = MAX_CHARS_PER_TOKEN):
    """All spans of a text: the base spans, and random runs not already inside a base span."""
    text = text or ""
    base = base_spans(text)
    starts, furthest = [a for a, _, _ in base], [-1, *accumulate((b for _, _, b in base), max)]
    # inside a base span: one that starts no later reaches as far
    more = [s for s in random_spans(text, encoding, limit) if furthest[bisect_right(starts, s[0])] < s[2]]
    return base, sorted(base + more)


def _scanner(path: str, limit: float):
    encoding = vocabulary(path)

    def one(text):
        base, spans = scan_text(text, encoding, limit)
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        return (*counts[:3], hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), counts[3])

    return one


FIELDS = [("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string"),
          ("spans", "string"), ("n_random", "bigint")]


def scan_secrets(docs: DataFrame, path: str | None = None, limit: float = MAX_CHARS_PER_TOKEN,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secret spans of every whole text, one row per input row (repeated rows included).

    ``spans`` lists ``kind:start:end`` by start, then kind; code points, end
    exclusive.  A null or empty text has no spans (``spans`` is empty, the digest
    is that of the empty string); a null id stays null; an empty table gives no
    rows; other columns are ignored.
    """
    return map_texts(texts_of(docs, id_col, text_col), _scanner, (path or default_vocabulary(), limit), FIELDS)


def masked(text: str, spans, mark: str) -> str:
    """The text with each span (overlapping ones joined) replaced by ``mark``."""
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def _masker(path: str, limit: float, mark: str):
    encoding = vocabulary(path)

    def one(text):
        if text is None:
            return (None, False)
        _, spans = scan_text(text, encoding, limit)
        return (masked(text, spans, mark), True) if spans else (text, False)

    return one


def redact_secrets(docs: DataFrame, path: str | None = None, limit: float = MAX_CHARS_PER_TOKEN,
                   mark: str = "[SECRET]", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with every found span replaced by ``mark``.

    Texts without a span stay as they are; a null text stays null.  Where a
    length column exists, it is set to the new length of changed texts.
    """
    names, types = docs.columns, [f.dataType for f in docs.schema.fields]
    at = names.index(text_col)
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    made = map_texts(plain, _masker, (path or default_vocabulary(), limit, mark),
                     [("_text", "string"), ("_changed", "boolean")], text_at=at, hand_back=True,
                     forget=[vocabulary])
    out = []
    for i, name in enumerate(names):
        if i == at:
            col = F.col("_text")
        elif name == length_col:
            col = F.when(F.col("_changed"), F.length("_text").cast(types[i])).otherwise(F.col(f"_c{i}"))
        else:
            col = F.col(f"_c{i}")
        out.append(col.alias(name))
    return made.select(*out)
