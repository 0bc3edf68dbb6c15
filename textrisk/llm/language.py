"""Language identification by hyperdimensional profiles.

Each letter has a fixed random vector of +1 and -1. A trigram is bound from its letters'
vectors, the first shifted by two places, the second by one, multiplied place by place. A
document's vector is the sum over its trigrams; a language's prototype is the sum over its
documents, each weighted to the same total. Documents get the language whose prototype has
the largest cosine with theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textrisk.llm.sums import array_sums
from textrisk.llm.words import SLICE_BYTES, slices, small_batches

DIMENSIONS = 1024
UNKNOWN = "und"
MOST_LANGUAGES = 1000

# A document's trigram weights add up to this in a prototype, less a remainder below its number
# of letters; whole numbers add up to the same sum in any order. A text has fewer than 2^31
# letters, so its weight is never 0. Up to two million texts of a slice stay below 2^53, and two
# billion rows of a language below 2^63.
_DOCUMENT_WEIGHT = 1 << 32
# Trigrams turned into vectors at once, and cells of a count matrix.
_TRIGRAM_BLOCK = 2048
_MATRIX_CELLS = 1 << 20
# Trigrams whose vectors a task keeps, at most.
_KEPT_TRIGRAMS = 16384


@cache
def _is_letter() -> np.ndarray:
    return np.array([chr(code).isalpha() for code in range(0x110000)])


@cache
def _letter(code: int, dimensions: int) -> np.ndarray:
    """Vector of a letter; code 0 is the end of a word."""
    draws = np.random.default_rng([code, 7]).integers(0, 2, dimensions, dtype=np.int8)
    return draws * 2 - 1


# Bound vectors of this process, by dimensions: sorted trigrams and their vectors.
_kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _bind(codes: np.ndarray, dimensions: int) -> np.ndarray:
    letters, places = np.unique(codes, return_inverse=True)
    table = np.stack([_letter(int(code), dimensions) for code in letters])
    places = places.reshape(codes.shape)
    bound = np.roll(table, 2, axis=1)[places[:, 0]]
    bound *= np.roll(table, 1, axis=1)[places[:, 1]]
    bound *= table[places[:, 2]]
    return bound


@dataclass(frozen=True)
class Trigrams:
    """Trigram occurrences of some texts: the text, and the number of the trigram among the
    distinct ones; ``codes`` has the three code points of each distinct trigram."""

    texts: np.ndarray
    numbers: np.ndarray
    codes: np.ndarray

    def blocks(self) -> Iterator[tuple[int, int]]:
        for begin in range(0, len(self.codes), _TRIGRAM_BLOCK):
            yield begin, min(begin + _TRIGRAM_BLOCK, len(self.codes))

    def vectors(self, begin: int, end: int, dimensions: int) -> np.ndarray:
        """Bound vectors of some trigrams; those of earlier texts are kept, up to a bound."""
        codes = self.codes[begin:end]
        keys = (codes[:, 0] << 42) | (codes[:, 1] << 21) | codes[:, 2]
        nothing = np.zeros(0, np.int64), np.zeros((0, dimensions), np.int8)
        known, table = _kept.get(dimensions, nothing)
        new = ~np.isin(keys, known)
        if new.any():
            if len(known) + new.sum() > _KEPT_TRIGRAMS:
                (known, table), new = nothing, np.ones(len(keys), bool)
            known = np.concatenate([known, keys[new]])
            table = np.concatenate([table, _bind(codes[new], dimensions)])
            order = np.argsort(known)
            _kept[dimensions] = known, table = known[order], table[order]
        return table[np.searchsorted(known, keys)]

    def counts(self, begin: int, end: int, first: int, last: int) -> np.ndarray:
        """Occurrences of trigrams ``begin`` to ``end`` in the texts ``first`` to ``last``."""
        lo, hi = np.searchsorted(self.texts, [first, last])
        numbers, texts = self.numbers[lo:hi], self.texts[lo:hi] - first
        if end - begin < len(self.codes):
            inside = (numbers >= begin) & (numbers < end)
            numbers, texts = numbers[inside], texts[inside]
        width = end - begin
        cells = np.bincount(texts * width + (numbers - begin), minlength=(last - first) * width)
        return cells.reshape(last - first, width)


def trigrams(texts: list[str | None]) -> Trigrams:
    """Trigrams of letters, with the ends of words; lower case. Whole texts are read."""
    joined = "\0".join((text or "").replace("\0", " ") for text in texts).lower()
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.cumsum(points == 0)
    used = np.flatnonzero(np.bincount(points, minlength=1))
    used = used[_is_letter()[used]]
    numbering = np.zeros(max(int(points.max(initial=0)) + 1, 1), np.int64)
    numbering[used] = np.arange(1, len(used) + 1)
    letters = numbering[points]
    # Runs of other characters are one end of a word.
    padded = np.concatenate([[0], letters, [0]])
    keep = np.concatenate([[True], (padded[1:] != 0) | (padded[:-1] != 0)])
    owners = np.concatenate([[0], owner, [owner[-1] if len(owner) else 0]])[keep]
    padded = padded[keep]
    middle = np.flatnonzero(padded[1:-1]) + 1
    base = len(used) + 1
    codes = (padded[middle - 1] * base + padded[middle]) * base + padded[middle + 1]
    if base**3 <= 1 << 24:
        seen = np.flatnonzero(np.bincount(codes, minlength=1))
        place = np.zeros(base**3, np.int64)
        place[seen] = np.arange(len(seen))
        numbers = place[codes]
    else:
        seen, numbers = np.unique(codes, return_inverse=True)
    points_of = np.concatenate([[0], used])
    triples = np.stack([seen // base**2, seen // base % base, seen % base], axis=1)
    return Trigrams(owners[middle], numbers, points_of[triples])


def document_vectors(texts: list[str | None], dimensions: int) -> np.ndarray:
    found = trigrams(texts)
    vectors = np.zeros((len(texts), dimensions), np.float32)
    for begin, end in found.blocks():
        bound = found.vectors(begin, end, dimensions).astype(np.float32)
        step = max(_MATRIX_CELLS // (end - begin), 1)
        for first in range(0, len(texts), step):
            last = min(first + step, len(texts))
            counts = found.counts(begin, end, first, last).astype(np.float32)
            vectors[first:last] += counts @ bound
    return vectors


def _profile_rows(batches, dimensions: int):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for begin, end in slices(batch.column(1), SLICE_BYTES // 2):
            languages = np.array(batch.column(0).slice(begin, end - begin).to_pylist(), object)
            found = trigrams(batch.column(1).slice(begin, end - begin).to_pylist())
            lengths = np.bincount(found.texts, minlength=end - begin)
            weights = _DOCUMENT_WEIGHT // np.maximum(lengths, 1)
            names = sorted(set(languages))
            kind = np.searchsorted(names, languages)
            for lo, hi in found.blocks():
                bound = found.vectors(lo, hi, dimensions).astype(np.float64)
                inside = (found.numbers >= lo) & (found.numbers < hi)
                text = found.texts[inside]
                cells = np.bincount(
                    kind[text] * (hi - lo) + found.numbers[inside] - lo,
                    weights=weights[text], minlength=len(names) * (hi - lo),
                ).reshape(len(names), hi - lo)
                # Whole numbers far below 2^53: the product is exact.
                for name, added in zip(names, (cells @ bound).astype(np.int64)):
                    sums[name] = sums.get(name, 0) + added
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(sums), pa.string()),
            pa.array([one.tolist() for one in sums.values()], pa.list_(pa.int64())),
        ],
        names=["lang", "vector"],
    )


@dataclass(frozen=True)
class LanguageProfiles:
    languages: tuple[str, ...]
    prototypes: np.ndarray  # one unit vector per language

    def cosines(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cosine of each text with each language, and which texts have a letter."""
        vectors = document_vectors(texts, self.prototypes.shape[1]).astype(np.float64)
        lengths = np.linalg.norm(vectors, axis=1)
        # A bundle of an even number of trigrams may cancel out: its cosines are 0.
        cosines = vectors @ self.prototypes.T / np.where(lengths > 0, lengths, 1)[:, None]
        return cosines, np.array([any(map(str.isalpha, text or "")) for text in texts], bool)


def fit_profiles(
    labelled: DataFrame, dimensions: int = DIMENSIONS, most_languages: int = MOST_LANGUAGES
) -> LanguageProfiles:
    """Prototypes of all languages from all rows of ``lang`` and ``text`` without nulls."""
    small_batches(labelled.sparkSession)
    rows = labelled.select("lang", "text").where("lang is not null and text is not null")
    partial = rows.mapInArrow(
        lambda batches: _profile_rows(batches, dimensions), "lang string, vector array<bigint>"
    )
    sums = array_sums(partial, "lang", "vector", most_languages)
    prototypes = np.array([one / max(np.linalg.norm(one), 1.0) for one in sums.values()])
    return LanguageProfiles(tuple(sums), prototypes.reshape(len(sums), dimensions))


def _predict_rows(batches, profiles: LanguageProfiles):
    for batch in batches:
        for begin, end in slices(batch.column(batch.num_columns - 1), SLICE_BYTES // 2):
            part = batch.slice(begin, end - begin)
            texts = part.column(part.num_columns - 1).to_pylist()
            names, scores = [], []
            if profiles.languages:
                cosines, lettered = profiles.cosines(texts)
                best = cosines.argmax(axis=1)
                for row, place in enumerate(best):
                    known = bool(lettered[row])
                    names.append(profiles.languages[place] if known else UNKNOWN)
                    scores.append(min(max(float(cosines[row, place]), 0.0), 1.0) if known else 0.0)
            else:
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            columns = [*part.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(
                columns, names=[*part.schema.names[:-1], "lang_pred", "score"]
            )


def predict_language(
    documents: DataFrame, profiles: LanguageProfiles, keep: list[Column]
) -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and its cosine ``score``, one row per row.

    Texts that are null or have no letter are ``und`` with score 0, as is every text if
    nothing was learned. Ties go to the language that comes first in the alphabet.
    """
    small_batches(documents.sparkSession)
    rows = documents.select(*keep, F.col("text").cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(
        lambda batches: _predict_rows(batches, profiles),
        f"{schema}, lang_pred string, score double",
    )
