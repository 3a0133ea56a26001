"""Token counts: batch encoding inside Arrow functions that returns lengths only.

Each Arrow batch is cut into runs of about equal bytes.  Texts are split at safe
boundaries -- before a space that follows a visible character, which no piece of
the model spans (checked when the model is loaded) -- so a long text is encoded
in short parts, and each distinct part of a run goes to the library once.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from traitmatch.llm.common import arrow_batch, byte_slices, schema_of, texts_of

BATCH_BYTES = 2 << 20      # text bytes per run
CACHED_PARTS = 300_000     # cached part lengths per worker, then it starts anew
CACHED_CHARS = 48
SPACE = "▁"           # the model's visible space
FIELDS = [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]

# A safe boundary; the space itself is the dummy prefix of the part behind it.
PART = re.compile(rf"(?<=[^ {SPACE}]) ")


class PieceCounter:
    """Lengths of sentencepiece encodings."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        # A boundary is safe only if no piece has a space after a visible character, and if a leading
        # space of a part is exactly the dummy prefix that the library adds to a text.
        self.safe = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces) and all(
            self.model.encode(a + " " + b) == self.model.encode(a) + self.model.encode(b)
            for a, b in (("a", "b"), ("a", " b"), ("a.", "\nb"), ("x", "  y")))
        # the part behind a final boundary is empty: only the space itself is left
        self.last_space = len(self.model.encode("a ")) - len(self.model.encode("a"))
        self.cache: dict[str, int] = {"": self.last_space}

    def lengths(self, texts: list[str]) -> list[int]:
        """Token counts of texts, by one library call for the parts not yet known."""
        if not self.safe:
            return [len(x) for x in self.model.encode(texts, num_threads=1)]
        cache = self.cache
        parts = [PART.split(t) if t else [] for t in texts]
        new = list(dict.fromkeys(p for each in parts for p in each if p not in cache))
        known = dict(zip(new, map(len, self.model.encode(new, num_threads=1)))) if new else {}
        out = [sum([cache[p] if p in cache else known[p] for p in each]) for each in parts]
        if len(cache) + len(known) > CACHED_PARTS:
            cache.clear()
            cache[""] = self.last_space
        cache.update((p, n) for p, n in known.items() if len(p) <= CACHED_CHARS)
        return out


class JsonCounter:
    """Lengths of tokenizers-library encodings; texts go whole, since any split may change merges."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x.ids) for x in self.model.encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def counter(path: str):
    return JsonCounter(path) if path.endswith(".json") else PieceCounter(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per input row (repeated rows included).

    A null text counts as empty (no bytes, no tokens); a null id stays null; an
    empty table gives no rows; other columns are ignored.
    """
    path = vocabulary or default_vocabulary()

    def run(batches):
        count = counter(path)
        for batch in batches:
            for part in byte_slices(batch, 1, BATCH_BYTES):
                texts = [t or "" for t in part.column(1).to_pylist()]
                n = count.lengths(texts)
                yield arrow_batch(FIELDS, [part.column(0), [len(t.encode()) for t in texts],
                                           pa.array(n, pa.int64()), [x > limit for x in n]])

    return texts_of(docs, id_col, text_col).mapInArrow(run, schema_of(FIELDS))
