"""Toxicity: a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words counts their common subsequences of ``ORDER`` symbols, word ends
included, each weighted down for every symbol it leaves out.  An insult with gaps or inserted
characters keeps most of its subsequences and stays close to the plain one.
Landmarks are words of the training texts; a sentence is described by the greatest
kernel value of its words with each landmark, mapped by the inverse root of the
landmarks' own kernel matrix (Nyström).

Labels are given per document, but an insult stands in one sentence.  A first machine on whole
documents picks the sentence that speaks most for the label; a second one is
trained on these labelled sentences, on copies with a character put into each word, and on the
documents beside them.  A document takes the greatest
decision of its sentences and of itself, mapped to a probability by rising steps
fitted on documents that trained neither machine.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitmatch.llm.common import arrow_batch, byte_slices, schema_of, texts_of, tidy
from traitmatch.llm.labels import labelled_sample
from traitmatch.llm.langid import remainder
from traitmatch.plans.lineage import cut_lineage

MAX_TRAIN_ROWS = 20_000       # documented bound of the training sample (labelled documents)
TOXIC_LANDMARKS = 160
CLEAN_LANDMARKS = 64
POOL = 1024                   # candidate words of a kind that reach the driver
ALIKE = 0.9                   # a landmark is not taken beside a more similar one
ORDER = 3
SPAN = 5                      # symbols from the first to the last of a subsequence
DECAY = 0.5                   # per symbol left out
POWER = 2                     # of the normalised kernel (a power of a kernel is one)
FLOOR = 0.5                   # smaller normalised values count as 0
WINDOW, STEP = 24, 12         # a longer word is seen through overlapping windows
THRESHOLD = 0.7
CACHED_WORDS = 200_000        # words of a generation whose kernel row (or lack of one) a worker holds; two are held
CACHED_ROWS = 50_000
SLICE = 1 << 20
UNITS, PRODUCTS = 4096, 256    # words whose bound, and whose products with all landmarks, are taken at a time
POOLED = 8192                  # kernel rows gathered at a time (of words, or of sentences)
CLEAN_SENTENCES = 2           # worst sentences of a clean document used in training
FIELDS = [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]

INSERTED = "._-*aeioxz"        # put into words of labelled sentences for disturbed copies of them
ENDS, SINGLE = r"[.!?]$", r"^[\pL\pN_][^\pL\pN_\s]?$"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# symbols: letters 1..26, digits 27, word start 29 30, word end 31, a character beyond ASCII one of
# 32..63 by its code; 0 (punctuation) is only a gap, never part of a subsequence
FIRST, SECOND, LAST, DIGIT = 29, 30, 31, 27
MARKS = 3
_ASCII = np.array([ord(chr(c).lower()) - 96 if chr(c).isalpha() else DIGIT if chr(c).isdigit() else 0
                   for c in range(128)], np.int32)
OFFSETS = [(a, b) for b in range(ORDER - 1, SPAN) for a in range(1, b)]


@dataclass
class Tokens:
    """Words of some texts: distinct ``words``, and for each occurrence its word, sentence and text (all numbers).

    ``text_of`` holds the text of each sentence; sentences are numbered in the order of the texts.
    """

    words: list[str]
    code: np.ndarray
    sentence: np.ndarray
    text_of: np.ndarray
    n_texts: int

    @classmethod
    def of(cls, column: pa.Array) -> Tokens:
        """Lower-cased words between blanks, without outer punctuation; a sentence ends with a line or after ``.!?``.

        Three or more single characters in a row ("s p e l l e d") are one more word of their
        sentence, with gaps.
        """
        lines = pc.split_pattern(pc.utf8_lower(pc.fill_null(column, "")), "\n")
        parts = pc.utf8_split_whitespace(lines.flatten())
        tokens, line = parts.flatten(), pc.list_parent_indices(parts).to_numpy()
        full = pc.not_equal(pc.binary_length(tokens), 0)
        tokens, line = tokens.filter(full), line[full.to_numpy(zero_copy_only=False)]
        raw = tokens.dictionary_encode()
        code = raw.indices.to_numpy()
        ends, single = (pc.match_substring_regex(raw.dictionary, r).to_numpy(zero_copy_only=False)[code] for r in (ENDS, SINGLE))
        plain = pc.utf8_trim(raw.dictionary, characters=PUNCTUATION).dictionary_encode()
        words, code = plain.dictionary.to_pylist(), plain.indices.to_numpy()[code].astype(np.int64)
        start = np.append(True, (line[1:] != line[:-1]) | ends[:-1]) if len(code) else np.zeros(0, bool)
        sentence = np.cumsum(start) - 1
        text_of = pc.list_parent_indices(lines).to_numpy()[line[start]].astype(np.int64)
        at = np.nonzero(single)[0]
        first = np.append(True, (np.diff(at) != 1) | (line[at[1:]] != line[at[:-1]])) if len(at) else np.zeros(0, bool)
        begins = np.nonzero(first)[0]
        spelled = [at[i:j] for i, j in zip(begins, np.append(begins[1:], len(at))) if j - i >= 3]
        extra = ["_".join(words[c] for c in code[run]) for run in spelled]
        code = np.append(code, len(words) + np.arange(len(extra)))
        sentence = np.append(sentence, [sentence[run[0]] for run in spelled]).astype(np.int64)
        return cls(words + extra, code, sentence, text_of, len(column))

    @classmethod
    def of_sentences(cls, groups: list[list[str]]) -> Tokens:
        """Given words, each group a sentence (and a text) of its own."""
        numbers: dict[str, int] = {}
        code = np.array([numbers.setdefault(w, len(numbers)) for g in groups for w in g], np.int64)
        sentence = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
        return cls(list(numbers), code, sentence, np.arange(len(groups)), len(groups))

    def words_of(self, sentences: np.ndarray) -> list[list[str]]:
        """The words of some sentences (each named once or more)."""
        order = np.argsort(self.sentence, kind="stable")
        low, high = (np.searchsorted(self.sentence[order], sentences, side) for side in ("left", "right"))
        return [[self.words[c] for c in self.code[order[i:j]]] for i, j in zip(low, high)]


def windows(word: str) -> list[str]:
    return [word] if len(word) <= WINDOW else [word[i:i + WINDOW] for i in range(0, len(word) - STEP, STEP)]


def disturbed(word: str) -> str:
    """A word of four letters or more with one character put into it; place and character are fixed by the word."""
    if len(word) < 4:
        return word
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    at = 1 + h % (len(word) - 1)
    return word[:at] + INSERTED[(h >> 8) % len(INSERTED)] + word[at:]


class Symbols:
    """Units as one array of symbols, with word marks and enough zeros after each to keep patterns apart."""

    def __init__(self, units: list[str]):
        inner = np.array([len(u) for u in units], np.int64)
        sizes = inner + MARKS + SPAN
        self.starts = np.cumsum(sizes) - sizes
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.n = int(sizes.sum())
        self.owner = np.repeat(np.arange(len(units)), sizes)
        self.s = np.zeros(self.n + SPAN, np.int32)
        at = np.arange(len(points)) + np.repeat(self.starts + 2 - (np.cumsum(inner) - inner), inner)
        self.s[at] = np.where(points < 128, _ASCII[np.minimum(points, 127)], 32 + points % 32)
        self.s[self.starts], self.s[self.starts + 1], self.s[self.starts + 2 + inner] = FIRST, SECOND, LAST

    def patterns(self):
        """``valid, code, weight`` of the subsequences at every position, one pattern of gaps at a time."""
        s, n = self.s, self.n
        head = s[:n] << 12
        for a, b in OFFSETS:
            valid = (s[:n] > 0) & (s[a:n + a] > 0) & (s[b:n + b] > 0)
            yield valid, head | (s[a:n + a] << 6) | s[b:n + b], DECAY ** (b + 1 - ORDER)

    def summed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``owner, code, weight``: every subsequence of each unit once, with its summed weight, in order of owner."""
        keys, weights = [], []
        for valid, code, weight in self.patterns():
            at = np.nonzero(valid)[0]
            keys.append((self.owner[at] << 18) | code[at])
            weights.append(np.full(len(at), weight))
        unique, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        return unique >> 18, unique & ((1 << 18) - 1), np.bincount(inverse, np.concatenate(weights), len(unique))


class LandmarkKernel:
    """Normalised kernel values of words with a list of landmarks, 0 below ``floor``, to the power ``POWER``."""

    def __init__(self, landmarks: list[str], floor: float = FLOOR):
        self.landmarks, self.floor = landmarks, floor
        owner, code, weight = Symbols(landmarks).summed()
        norm = np.sqrt(np.bincount(owner, weight ** 2, len(landmarks)))
        known, at = np.unique(code, return_inverse=True)
        self.row_of = np.full(1 << 18, -1, np.int32)
        self.row_of[known] = np.arange(len(known))
        # entries of each known code: landmark and normalised weight
        order = np.argsort(at, kind="stable")
        self.entry_of, self.entry_weight = owner[order], (weight / norm[owner])[order]
        self.first = np.searchsorted(at[order], np.arange(len(known) + 1))
        self.most = np.zeros(1 << 18, np.float32)
        np.maximum.at(self.most, code, (weight / norm[owner]).astype(np.float32))
        self.forget()

    def forget(self) -> None:
        # row 0 is that of all words unlike every landmark
        self.words: dict[str, int] = {}
        self.before: dict[str, int] = {}
        self.cache = np.zeros((CACHED_ROWS, len(self.landmarks)), np.float32)     # takes memory as it is filled
        self.held = 1

    def _may_reach(self, symbols: Symbols) -> tuple[np.ndarray, np.ndarray]:
        """Units whose kernel value with some landmark can reach the floor, by sums alone, and all least norms.

        A subsequence that is repeated only makes the true norm larger, so the bound holds.
        """
        reach, square = np.zeros(symbols.n, np.float32), np.zeros(symbols.n, np.float32)
        for valid, code, weight in symbols.patterns():
            reach += np.where(valid, self.most[code], np.float32(0)) * np.float32(weight)
            square += valid * np.float32(weight * weight)
        reach, square = (np.add.reduceat(v, symbols.starts) for v in (reach, square))
        return np.nonzero(reach >= (self.floor - 1e-4) * np.sqrt(square))[0], np.sqrt(square)

    def _products(self, symbols: Symbols, n: int) -> np.ndarray:
        """Products of ``n`` units with every (normalised) landmark, from the landmarks' entries of each subsequence."""
        size = len(self.landmarks)
        keys, values = [], []
        for valid, code, weight in symbols.patterns():
            row = np.where(valid, self.row_of[code], -1)
            at = np.nonzero(row >= 0)[0]
            start = self.first[row[at]]
            many = self.first[row[at] + 1] - start
            entry = np.arange(int(many.sum())) + np.repeat(start - (np.cumsum(many) - many), many)
            keys.append(np.repeat(symbols.owner[at] * size, many) + self.entry_of[entry])
            values.append(self.entry_weight[entry] * weight)
        return np.bincount(np.concatenate(keys), np.concatenate(values), n * size).reshape(n, size)

    def rows(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units that are like some landmark, and a row of kernel values for each."""
        numbers, found = [], []
        for i in range(0, len(units), UNITS):
            part = units[i:i + UNITS]
            may, least = self._may_reach(Symbols(part))
            for j in range(0, len(may), PRODUCTS):
                at = may[j:j + PRODUCTS]
                products = self._products(Symbols([part[k] for k in at]), len(at))
                like = (products >= (self.floor - 1e-4) * least[at][:, None]).any(axis=1)
                at, products = at[like], products[like]
                if not len(at):
                    continue
                owner, _, weight = Symbols([part[k] for k in at]).summed()
                rows = products / np.sqrt(np.bincount(owner, weight ** 2, len(at)))[:, None]
                rows[rows < self.floor] = 0
                like = rows.any(axis=1)
                numbers.append(i + at[like])
                found.append((rows[like] ** POWER).astype(np.float32))
        return (np.concatenate(numbers) if numbers else np.zeros(0, np.int64),
                np.concatenate(found) if found else np.zeros((0, len(self.landmarks)), np.float32))

    def numbers(self, words: list[str]) -> np.ndarray:
        """Cache row of every word: its greatest kernel value with each landmark over the word's windows."""
        if self.held > CACHED_ROWS:
            self.forget()
        elif len(self.words) > CACHED_WORDS:
            self.before, self.words = self.words, {}
        at = list(map(self.words.get, words))
        if None in at:
            missing = {w: 0 for w, n in zip(words, at) if n is None}
            old = [w for w in missing if w in self.before]
            self.words.update((w, self.before[w]) for w in old)
            for w in old:
                del missing[w]
            self._add(list(missing))
            at = list(map(self.words.__getitem__, words))
        return np.array(at, np.int64)

    def _add(self, new: list[str]) -> None:
        cut = [windows(w) for w in new]
        of = np.repeat(np.arange(len(new)), list(map(len, cut))).astype(np.int64)
        like, rows = self.rows([u for c in cut for u in c])
        whose, first = np.unique(of[like], return_index=True)
        rows = np.maximum.reduceat(rows, first, axis=0) if len(first) else rows
        if self.held + len(rows) > len(self.cache):
            grown = np.zeros((self.held + len(rows) + CACHED_ROWS // 8, len(self.landmarks)), np.float32)
            grown[:self.held] = self.cache[:self.held]
            self.cache = grown
        self.cache[self.held:self.held + len(rows)] = rows
        self.words.update(dict.fromkeys(new, 0))
        self.words.update((new[w], self.held + k) for k, w in enumerate(whose.tolist()))
        self.held += len(rows)

    def alike(self, tokens: Tokens) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Sentences with a word like some landmark, in order, and a row each: the greatest value of its words with each.

        Yields runs of sentences that hold ``POOLED`` different (sentence, word) pairs, or one sentence of more.
        """
        row = self.numbers(tokens.words)[tokens.code] if tokens.words else np.zeros(0, np.int64)
        like = np.nonzero(row)[0]
        # a word counts once a sentence, however often it stands there
        pair = np.unique(tokens.sentence[like] * self.held + row[like])
        sentence, row = pair // self.held, pair % self.held
        whose, first = np.unique(sentence, return_index=True)
        bounds = np.append(first, len(row))
        i = 0
        while i < len(whose):
            j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + POOLED, "right")) - 1)
            if bounds[j] - bounds[i] <= POOLED:
                rows = np.maximum.reduceat(self.cache[row[bounds[i]:bounds[j]]], first[i:j] - bounds[i], axis=0)
            else:
                rows = np.zeros((1, len(self.landmarks)), np.float32)
                for k in range(bounds[i], bounds[j], POOLED):
                    np.maximum(rows[0], self.cache[row[k:min(k + POOLED, bounds[j])]].max(axis=0), out=rows[0])
            yield whose[i:j], rows
            i = j

    def pooled(self, tokens: Tokens) -> np.ndarray:
        """A row per sentence, of zeros for one without a word like some landmark."""
        out = np.zeros((len(tokens.text_of), len(self.landmarks)), np.float32)
        for whose, rows in self.alike(tokens):
            out[whose] = rows
        return out

    def matrix(self, words: list[str]) -> np.ndarray:
        return self.pooled(Tokens.of_sentences([[w] for w in words]))


def by_text(values: np.ndarray, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a sentence, and the greatest of their sentences' values (or rows of values)."""
    whose, first = np.unique(tokens.text_of, return_index=True)
    return whose, np.maximum.reduceat(values, first, axis=0) if len(first) else values


def inverse_root(matrix: np.ndarray) -> np.ndarray:
    """Inverse square root of the landmarks' kernel matrix (eigenvalues below 1e-6 of the largest are left out)."""
    values, vectors = np.linalg.eigh(matrix.astype(np.float64))
    keep = values > 1e-6 * max(float(values.max(initial=0)), 1e-12)
    return (vectors[:, keep] / np.sqrt(values[keep])) @ vectors[:, keep].T


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 3e-4, rounds: int = 60) -> np.ndarray:
    """Squared-hinge linear machine (weights and, last, bias) by Newton steps on its support vectors."""
    d = x.shape[1]
    t, w = 2.0 * y - 1, np.zeros(d + 1)
    penalty = np.append(np.full(d, ridge), 1e-9)
    share = weight / weight.sum()

    def margins(w):
        return 1 - t * (x @ w[:-1].astype(x.dtype) + w[-1])

    def loss(w):
        return float((share * np.maximum(0, margins(w)) ** 2).sum() + (penalty * w * w).sum())

    now = loss(w)
    for _ in range(rounds):
        margin = margins(w)
        on = np.nonzero(margin > 0)[0]
        pull = share[on] * t[on] * margin[on]
        grad, hess = 2 * penalty * w, 2 * np.diag(penalty) + 1e-12 * np.eye(d + 1)
        for i in range(0, len(on), 4096):             # a block of support vectors at a time
            a = np.column_stack([x[on[i:i + 4096]], np.ones(len(on[i:i + 4096]))])
            grad -= 2 * pull[i:i + 4096] @ a
            hess += 2 * (a.T * share[on[i:i + 4096]]) @ a
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-10:
            break
    return w


def fit_calibration(f: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float]]:
    """Rising steps (decision, probability): pooled neighbours of equal or falling share, each with half a
    document of either label added.  Without both labels: a fixed slope."""
    if not 0 < y.sum() < len(y):
        return [-1.0, 0.0, 1.0], [0.05, 0.5, 0.95]
    order = np.lexsort([y, f])
    blocks: list[list[float]] = []                     # documents, toxic ones, least and greatest decision
    for d, label in zip(f[order].tolist(), y[order].tolist()):
        blocks.append([1, label, d, d])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, k, _, high = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + k, blocks[-1][2], high]
    share = np.maximum.accumulate([(k + 0.5) / (n + 1) for n, k, _, _ in blocks])
    return [d for b in blocks for d in b[2:]], np.repeat(share, 2).tolist()


class ToxicityModel:
    """Landmarks, one weight per landmark (the Nyström map is folded in), bias and calibration."""

    def __init__(self, landmarks: list[str], weights: np.ndarray, bias: float):
        self.landmarks, self.weights, self.bias = landmarks, weights, bias
        self.steps = fit_calibration(np.zeros(0), np.zeros(0))

    def decisions(self, kernel: LandmarkKernel, tokens: Tokens) -> np.ndarray:
        """Greatest decision of each text's sentences and of its words as a whole (a text without words: the bias)."""
        out, best = np.full(tokens.n_texts, self.bias), np.full(tokens.n_texts, -np.inf)
        many = np.zeros(tokens.n_texts, np.int64)
        whole = np.zeros((tokens.n_texts, len(self.weights)), np.float32)
        for whose, x in kernel.alike(tokens):
            texts, first, n = np.unique(tokens.text_of[whose], return_index=True, return_counts=True)
            best[texts] = np.maximum(best[texts], np.maximum.reduceat(x @ self.weights, first))
            whole[texts] = np.maximum(whole[texts], np.maximum.reduceat(x, first, axis=0))
            many[texts] += n
        texts = np.nonzero(many)[0]
        # a text with further sentences has one that says nothing, of decision 0
        others = np.bincount(tokens.text_of, minlength=tokens.n_texts)[texts] > many[texts]
        best = np.where(others, np.maximum(best[texts], 0), best[texts])
        for i in range(0, len(texts), POOLED):
            at = texts[i:i + POOLED]
            out[at] += np.maximum(best[i:i + POOLED], whole[at] @ self.weights)
        return out

    def probability(self, decision: np.ndarray) -> np.ndarray:
        """The calibration's steps, joined by lines between them, with a small share of a logistic curve that tells ties apart."""
        smooth = 1 / (1 + np.exp(-np.clip(2 * decision, -30, 30)))
        return 0.98 * np.interp(decision, *self.steps) + 0.02 * smooth


# --- training ----------------------------------------------------------------------

def _sample_slices(batches):
    for batch in batches:
        for part in byte_slices(batch, 2, SLICE):
            yield part.column(1).to_numpy().astype(np.int64), Tokens.of(part.column(2))


def candidate_words(sample: DataFrame) -> tuple[list[str], dict[str, int]]:
    """Words most tied to toxic documents, and the most frequent other ones with their documents (``POOL`` each)."""
    def run(batches):
        for y, tokens in _sample_slices(batches):
            size = max(1, len(tokens.words))
            pair = np.unique(tokens.text_of[tokens.sentence] * size + tokens.code)          # each word once a text
            n = np.bincount(pair % size, minlength=size)
            toxic = np.bincount(pair % size, y[pair // size], size).astype(np.int64)
            units = [(u, i) for i, w in enumerate(tokens.words) for u in windows(w)]
            at = np.array([i for _, i in units], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in units], pa.string()), pa.array(toxic[at]), pa.array(n[at])],
                                             names=["word", "toxic", "n"])

    counted = cut_lineage(sample.mapInArrow(tidy(run), "word string, toxic bigint, n bigint").groupBy("word")
                          .agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")), "toxicity_words")
    rate = sample.agg(F.avg("y")).first()[0] or 0.0
    lift = (F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * rate + 1)
    bad = counted.filter((F.col("toxic") > 0) & (lift > 0)).orderBy(lift.desc(), "word").limit(POOL)
    good = counted.filter(lift <= 0).orderBy(F.col("n").desc(), "word").limit(POOL)
    return [r.word for r in bad.collect()], {r.word: r.n for r in good.collect()}


def choose_landmarks(bad: list[str], good: dict[str, int], n_bad: int = TOXIC_LANDMARKS,
                     n_good: int = CLEAN_LANDMARKS) -> list[str]:
    """Toxic candidates in their order, then the clean ones that are taken for them most often
    (documents times kernel value), none too similar to one of its kind already taken."""
    def spread(words: list[str], n: int) -> list[str]:
        taken: list[int] = []
        alike = LandmarkKernel(words).matrix(words) if words else None
        for i in range(len(words)):
            if len(taken) < n and not (taken and alike[i, taken].max() > ALIKE ** POWER):
                taken.append(i)
        return [words[i] for i in taken]

    chosen = spread(bad, n_bad)
    words = list(good)
    harm = LandmarkKernel(chosen).matrix(words).max(axis=1) * np.array(list(good.values()))
    return chosen + spread([words[i] for i in np.argsort(-harm, kind="stable") if harm[i] > 0], n_good)


def _vectors(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, how often, and values of the distinct vectors, in an order that is theirs alone."""
    table = (rows.groupBy("y", "x").agg(F.sum("n").alias("n")).orderBy("y", "x")).toArrow()
    x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.float32).reshape(-1, size)
    return table.column("y").to_numpy().astype(float), table.column("n").to_numpy().astype(float), x


def _counted(ys: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    counts = Counter(zip(ys.tolist(), map(bytes, x)))
    return pa.RecordBatch.from_arrays([pa.array([y for y, _ in counts], pa.int32()), pa.array([v for _, v in counts], pa.binary()),
                                       pa.array(list(counts.values()), pa.int64())], names=["y", "x", "n"])


def fit_toxicity(sample: DataFrame) -> ToxicityModel | None:
    """Model of a labelled sample; ``None`` without both labels or without a word in them.

    Three quarters of the documents train both machines, the last quarter (by the hash of the
    id), with a disturbed copy of each document, calibrates.  Reaches the driver: candidate words, the distinct vectors (a number a landmark)
    of documents, chosen sentences and their disturbed copies (at most ``1 + 2 * CLEAN_SENTENCES`` a
    document; those without a similar word are one), and the decisions of the last quarter.
    """
    calibrates = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    fitted = sample.filter(~calibrates)
    bad, good = candidate_words(fitted)
    if not bad or not good:
        return None
    landmarks = choose_landmarks(bad, good)
    size = len(landmarks)

    def whole(batches):
        for y, tokens in _sample_slices(batches):
            whose, x = by_text(_kernel(landmarks).pooled(tokens), tokens)
            yield _counted(y[whose], x)

    schema = "y int, x binary, n bigint"
    documents = _vectors(fitted.mapInArrow(tidy(whole), schema), size)
    if len(set(documents[0])) < 2:
        return None
    root = inverse_root(LandmarkKernel(landmarks).matrix(landmarks))

    def machine(y, n, x):
        """Both labels weigh the same."""
        return fit_svm(x @ root.astype(np.float32), y, np.where(y > 0, n / (n * y).sum(), n / (n * (1 - y)).sum()))

    direction = root @ machine(*documents)[:-1]

    def worst(batches):
        for y, tokens in _sample_slices(batches):
            x = _kernel(landmarks).pooled(tokens)
            # sentences of a text from the worst on, and their place among them
            order = np.lexsort([-(x @ direction), tokens.text_of])
            whose, first, many = np.unique(tokens.text_of, return_index=True, return_counts=True)
            place = np.arange(len(order)) - np.repeat(first, many)
            picked = order[place < np.where(y[tokens.text_of] > 0, 1, CLEAN_SENTENCES)]
            label = y[tokens.text_of[picked]]
            copies = Tokens.of_sentences([[disturbed(w) for w in g] for g in tokens.words_of(picked)])
            yield _counted(np.append(label, label), np.concatenate([x[picked], _kernel(landmarks).pooled(copies)]))

    labelled = _vectors(fitted.mapInArrow(tidy(worst), schema), size)
    second = machine(*(np.concatenate(pair) for pair in zip(documents, labelled)))
    model = ToxicityModel(landmarks, root @ second[:-1], float(second[-1]))

    def decide(batches):
        for batch in batches:
            for part in byte_slices(batch, 2, SLICE):
                tokens = Tokens.of(part.column(2))
                for each in (tokens, replace(tokens, words=[disturbed(w) for w in tokens.words])):
                    yield pa.RecordBatch.from_arrays(
                        [part.column(1), pa.array(model.decisions(_kernel(landmarks), each))], names=["y", "f"])

    table = sample.filter(calibrates).mapInArrow(tidy(decide), "y int, f double").toArrow()
    model.steps = fit_calibration(np.array(table.column("f").to_pylist(), float), np.array(table.column("y").to_pylist(), float))
    return model


# --- scoring -----------------------------------------------------------------------

_KERNELS: dict[str, LandmarkKernel] = {}


def _kernel(landmarks: list[str]) -> LandmarkKernel:
    """One kernel (and cache) a worker; another list of landmarks replaces it."""
    key = "\n".join(landmarks)
    if key not in _KERNELS:
        _KERNELS.clear()
        _KERNELS[key] = LandmarkKernel(landmarks)
    return _KERNELS[key]


def _score(shared, threshold: float, batches):
    model = shared.value
    for batch in batches:
        for part in byte_slices(batch, 2, SLICE):
            score = (model.probability(model.decisions(_kernel(model.landmarks), Tokens.of(part.column(2)))) if model
                     else np.full(part.num_rows, 0.5))
            yield arrow_batch(FIELDS, [part.column(0), part.column(1), score, (score >= threshold).astype(np.int32)])


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", max_rows: int = MAX_TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Toxicity score of every whole text; one row per input row, repeated rows included.

    Learns from at most ``max_rows`` labelled documents whose crc32(id) mod 3 is not 1
    (see :func:`traitmatch.llm.labels.labelled_sample`); a score reads the text alone.  A null or wordless text scores as a
    text unlike every landmark; a null id stays null (``held_out`` false); without both
    labels every score is 0.5; an empty table gives no rows; other columns are ignored.
    """
    rows = texts_of(docs, id_col, text_col)
    sample = cut_lineage(labelled_sample(rows, labels, label_col, 3, 1, max_rows), "toxicity_sample")
    shared = docs.sparkSession.sparkContext.broadcast(fit_toxicity(sample))     # words and numbers a landmark
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return (rows.select("doc_id", held_out.alias("held_out"), "text")
            .mapInArrow(tidy(partial(_score, shared, threshold)), schema_of(FIELDS)))
