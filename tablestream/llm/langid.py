"""Language of a text by unigrams over pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary. Each language has a probability
for every piece, and a word's probability is the sum over all ways to write it as
pieces: the forward algorithm. Piece probabilities come from expectation
maximisation over the same sums, on a bounded sample of labelled texts.

A text is scored as a whole. Its words repeat, so a worker keeps what it has found
for a word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablestream.llm.common import Batches, annotate, arrow, only

#: Labelled texts per language that the model is fitted on, about.
SAMPLE = 150
ROUNDS = 2
#: Pseudo-count of every piece in every language.
ALPHA = 0.05
#: Longer runs of letters are scored in parts of this length.
WORD = 24
#: Probability, per letter, of a letter that no piece covers.
FOREIGN = 1e-7
CACHED_WORDS = 700_000
#: New words scored together: their pieces take a few kilobytes each.
TOGETHER = 1024
#: Texts are scored together up to about this many words; a longer one is alone.
WORDS_AT_ONCE = 50_000
UNKNOWN = "und"
START = "▁"

LETTERS = re.compile(r"[^\W\d_]+")
PARTS = re.compile(rf"(?s).{{1,{WORD}}}")


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased; numerals that are no letters do not count."""
    found = LETTERS.findall(text.lower())
    if text.isascii():
        return found
    return [w for w in found if w.isalpha()] if not all(map(str.isalpha, found)) else found


def parts_of(word: str) -> list[str]:
    return [word] if len(word) <= WORD else PARTS.findall(word)


@lru_cache(maxsize=2)
def pieces(path: str) -> dict[str, int]:
    """The lower-case pieces of letters in a sentencepiece vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    kept = [p for p in names if (bare := p.removeprefix(START)).isalpha() and bare == bare.lower()]
    return {p: i for i, p in enumerate(dict.fromkeys(kept))}


def edges(words: list[str], vocabulary: dict[str, int]) -> np.ndarray:
    """All pieces in the words: columns word, start, end, piece (-1: foreign letter)."""
    longest = max(map(len, vocabulary), default=1)
    get = vocabulary.get
    out = []
    for w, word in enumerate(words):
        x = START + word
        n = len(x)
        for i in range(n):
            for j in range(i + 1, min(n, i + longest) + 1):
                k = get(x[i:j])
                if k is not None:
                    out.append((w, i, j, k))
                elif j == i + 1:
                    out.append((w, i, j, -1))
    return np.array(out, np.int32).reshape(-1, 4)


def by_step(found: np.ndarray) -> list[np.ndarray]:
    """Edges in groups of equal start and length: a word is in a group once at most."""
    key = found[:, 1].astype(np.int64) * 64 + (found[:, 2] - found[:, 1])
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.diff(key[order])) + 1
    return np.split(found[order], cuts) if len(order) else []


def forward(n: int, groups: list[np.ndarray], weight: np.ndarray) -> np.ndarray:
    """Summed probability of all prefixes: word x place x language."""
    alpha = np.zeros((n, WORD + 2, weight.shape[1]))
    alpha[:, 0] = 1.0
    for g in groups:
        w, i, j, k = g.T
        alpha[w, j] += alpha[w, i] * weight[k]
    return alpha


def fit_language(counts: list[tuple[str, int]], vocabulary: dict[str, int]) -> np.ndarray:
    """Piece probabilities of one language; the last entry is for foreign letters."""
    words = [w for w, _ in counts]
    times = np.array([c for _, c in counts], float)
    groups = by_step(edges(words, vocabulary))
    ends = np.array([len(w) + 1 for w in words])
    size = len(vocabulary)
    weight = np.append(np.full(size, 1.0 / size), FOREIGN)[:, None]
    for _ in range(ROUNDS):
        alpha = forward(len(words), groups, weight)
        beta = np.zeros((len(words), WORD + 2))
        beta[np.arange(len(words)), ends] = 1.0
        total = alpha[np.arange(len(words)), ends, 0]
        share = times / np.where(total > 0, total, 1.0)
        expected = np.zeros(size + 1)
        for g in reversed(groups):
            w, i, j, k = g.T
            part = weight[k, 0] * beta[w, j]
            np.add.at(expected, k, alpha[w, i, 0] * part * share[w])
            # Groups of the same start come together, so beta[i] is only read later.
            beta[w, i] += part
        expected = expected[:size] + ALPHA
        weight = np.append(expected / expected.sum(), FOREIGN)[:, None]
    return weight[:, 0]


@dataclass(frozen=True, eq=False)
class Model:
    languages: tuple[str, ...]
    weight: np.ndarray
    vocabulary_path: str

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        return scorer(self).predict(texts)


class Scorer:
    """Log probabilities of words, kept between texts."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        # Pages of the table take memory only once they are written.
        self.rows = np.zeros((CACHED_WORDS, len(self.model.languages)))

    def of(self, words: list[str]) -> np.ndarray:
        found = list(map(self.slot.get, words))
        if None in found:
            new = [w for w in dict.fromkeys(words) if w not in self.slot]
            if len(self.slot) + len(new) > len(self.rows):
                self.clear()
                new = list(dict.fromkeys(words))
            if len(new) > len(self.rows):
                # More than the cache holds: a table for these words only.
                self.rows = np.zeros((len(new), len(self.model.languages)))
            first = len(self.slot)
            for a in range(0, len(new), TOGETHER):
                part = new[a : a + TOGETHER]
                self.rows[first + a : first + a + len(part)] = self.score(part)
            self.slot.update(zip(new, range(first, first + len(new))))
            found = list(map(self.slot.__getitem__, words))
        return self.rows[found]

    def score(self, words: list[str]) -> np.ndarray:
        groups = by_step(edges(words, pieces(self.model.vocabulary_path)))
        alpha = forward(len(words), groups, self.model.weight)
        last = alpha[np.arange(len(words)), [len(w) + 1 for w in words]]
        return np.log(np.maximum(last, 1e-300))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        only(self)
        out, held, size = [], [], 0
        for text in texts:
            held.append([p for w in words_of(text or "") for p in parts_of(w)])
            size += len(held[-1])
            if size >= WORDS_AT_ONCE:
                out += self.predict_words(held)
                held, size = [], 0
        return out + self.predict_words(held)

    def predict_words(self, words: list[list[str]]) -> list[tuple[str, float]]:
        sizes = [len(w) for w in words]
        rows = self.of([w for group in words for w in group])
        total = np.zeros((len(words), len(self.model.languages)))
        filled = np.flatnonzero(sizes)
        if len(filled) and len(self.model.languages):
            starts = (np.cumsum(sizes) - sizes)[filled]
            total[filled] = np.add.reduceat(rows, starts, axis=0)
        out = []
        for size, line in zip(sizes, total, strict=True):
            if not size or not len(line):
                out.append((UNKNOWN, 0.0))
                continue
            best = int(line.argmax())
            out.append((self.model.languages[best], float(1 / np.exp(line - line[best]).sum())))
        return out


_SCORERS: dict[bytes, Scorer] = {}


def scorer(model: Model) -> Scorer:
    """One scorer per model in a worker, also over several tasks."""
    key = repr(model.languages).encode() + model.weight.tobytes()
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model)
    return _SCORERS[key]


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(
    labelled: DataFrame,
    vocabulary_path: str,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
) -> Model:
    """A model of the languages in ``labelled``; rows without text or language are left out.

    Fitted on about ``SAMPLE`` texts per language, those with the smallest hash of
    their id, so the words that reach the driver do not grow with the table.
    """
    rows = labelled.select(
        labelled[lang_col].cast("string").alias("lang"),
        labelled[text_col].cast("string").alias("text"),
        F.xxhash64(labelled[id_col].cast("string"), labelled[text_col]).alias("h"),
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model((), np.zeros((len(pieces(vocabulary_path)) + 1, 0)), vocabulary_path)
    # The hash is even over 2^64, so its first SAMPLE / n part holds about SAMPLE rows.
    picked = F.lit(False)
    for lang, n in counts.items():
        bound = int(min(1.0, SAMPLE / n) * 2.0**63) - 1
        own = F.pmod(F.col("h"), F.lit(2**62)) * 2 <= bound
        picked = picked | ((F.col("lang") == lang) & own)

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seen.update((lang, p) for w in words_of(text) for p in parts_of(w))
            columns = [[k[0] for k in seen], [k[1] for k in seen], list(seen.values())]
            types = (pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["lang", "word", "n"]
            )

    words = arrow(rows.where(picked).select("lang", "text"), count, "lang string, word string, n bigint")
    seen: dict[str, list[tuple[str, int]]] = {lang: [] for lang in sorted(counts)}
    for lang, word, n in sorted(
        tuple(r) for r in words.groupBy("lang", "word").agg(F.sum("n").alias("n")).collect()
    ):
        seen[lang].append((word, n))
    vocabulary = pieces(vocabulary_path)
    columns = [fit_language(w, vocabulary) for w in seen.values()]
    return Model(tuple(seen), np.stack(columns, axis=1), vocabulary_path)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``lang_pred`` and ``score``.

    ``und`` with score 0 for a null text, one without a letter, or a model without
    languages. ``score`` is the probability of the language among those learned. Of
    equally likely languages the first by name wins; repeated rows get the same.
    """

    def found(texts: list[str | None]) -> list[list]:
        return [list(c) for c in zip(*model.predict(texts), strict=True)]

    return annotate(docs, text_col, found, "lang_pred string, score double")
