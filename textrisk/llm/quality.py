"""Quality classifier: a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textrisk.llm.sums import array_sums
from textrisk.llm.words import (
    SPACED,
    WordClass,
    chain,
    find_words,
    slices,
    small_batches,
    text_bytes,
)

LINES = WordClass(lambda b: b != 10)

_SIGNS = {"exclaims": b"!", "bars": b"|", "signs": b"#$%&*", "stops": b".", "commas": b",",
          "quotes": b"\"'", "slashes": b"/\\", "marks": b"@:;<>=_~^`", "brackets": b"()[]{}",
          "queries": b"?", "dashes": b"-+"}
_KINDS = {
    "spaces": [32, *range(9, 14)], "breaks": [10], "digits": range(48, 58), "uppers": range(65, 91),
    "lowers": range(97, 123), "wide": range(192, 256), "controls": [*range(9), *range(14, 32), 127],
    **{name: list(found) for name, found in _SIGNS.items()},
}
STATISTICS = (
    "log_chars", "log_words", "log_lines", "word_length", "word_length_spread",
    "distinct_words", "top_word", "repeated_next", "distinct_trigrams", "distinct_lines",
    "upper_words", "wide_uppers", *_KINDS,
)


def _share(part, whole):
    """Variance-stabilised share; 0 of nothing."""
    return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))


def _varied(hashes: np.ndarray) -> tuple[int, int]:
    """Number of distinct values and occurrences of the most frequent one."""
    if not len(hashes):
        return 0, 0
    ordered = np.sort(hashes)
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
    return len(edges) - 1, int(np.diff(edges).max())


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def statistics(column: pa.Array) -> np.ndarray:
    """The transformed statistics of each whole text; null reads as empty."""
    data, bounds = text_bytes(column)
    texts = len(column)
    chars = _sums((data & 0xC0) != 0x80, bounds)
    words = find_words(data, bounds, SPACED)
    lines = find_words(data, bounds, LINES)
    trigrams = chain(words.hashes, 3)
    lengths = words.ends - words.starts
    counts = np.diff(words.first)
    spread = np.zeros(texts)
    mean = _sums(lengths, words.first) / np.maximum(counts, 1)
    squares = _sums(lengths * lengths, words.first) / np.maximum(counts, 1)
    spread = np.sqrt(np.maximum(squares - mean**2, 0))
    same_next = np.zeros(len(words.hashes), bool)
    same_next[:-1] = words.hashes[1:] == words.hashes[:-1]
    upper = (data >= 65) & (data <= 90)
    # Capitals of Latin-1, as in the second byte of their UTF-8 form.
    wide_upper = np.zeros(len(data), bool)
    wide_upper[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    lower_sum = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122))])
    upper_sum = np.concatenate([[0], np.cumsum(upper | wide_upper)])
    shouted = (upper_sum[words.ends] - upper_sum[words.starts] >= 2) & (
        lower_sum[words.ends] == lower_sum[words.starts]
    )
    distinct_words, top_word = np.zeros(texts), np.zeros(texts)
    distinct_trigrams, distinct_lines = np.zeros(texts), np.zeros(texts)
    for text in range(texts):
        own = words.of(text)
        distinct_words[text], top_word[text] = _varied(words.hashes[own])
        distinct_trigrams[text], _ = _varied(trigrams[own.start : max(own.stop - 2, own.start)])
        distinct_lines[text], _ = _varied(lines.hashes[lines.of(text)])
    line_counts = np.diff(lines.first)
    columns = [
        np.log1p(chars), np.log1p(counts), np.log1p(line_counts),
        np.log1p(mean), np.log1p(spread),
        _share(distinct_words, counts), _share(top_word, counts),
        _share(_sums(same_next, words.first), counts),
        _share(distinct_trigrams, np.maximum(counts - 2, 0)), _share(distinct_lines, line_counts),
        _share(_sums(shouted, words.first), counts), _share(_sums(wide_upper, bounds), chars),
    ]
    for members in _KINDS.values():
        chosen = np.zeros(256, bool)
        chosen[list(members)] = True
        columns.append(_share(_sums(chosen[data], bounds), chars))
    return np.stack(columns, axis=1)


def _statistic_rows(batches):
    for batch in batches:
        text = batch.column(batch.num_columns - 1)
        for begin, end in slices(text):
            part = batch.slice(begin, end - begin)
            found = statistics(part.column(part.num_columns - 1))
            flat = pa.array(found.ravel(), pa.float64())
            offsets = pa.array(np.arange(0, found.size + 1, found.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.ListArray.from_arrays(offsets, flat)],
                names=[*part.schema.names[:-1], "statistics"],
            )


def with_statistics(documents: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and the array ``statistics`` of each row's whole text."""
    small_batches(documents.sparkSession)
    rows = documents.select(*keep, documents[text].cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(_statistic_rows, f"{schema}, statistics array<double>")


def _moment_rows(batches):
    """Per class: rows, sums and sums of products, in one array."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        values = np.array(batch.column(1).to_pylist())
        for label in np.unique(labels):
            own = values[labels == label]
            moments = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
            found[int(label)] = found.get(int(label), 0) + moments
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(found), pa.int32()),
            pa.array([one.tolist() for one in found.values()], pa.list_(pa.float64())),
        ],
        names=["label", "moments"],
    )


@dataclass(frozen=True)
class QuadraticDiscriminant:
    """Class means and covariances; the factors are computed once, when fitted.

    ``scale`` holds the mean and deviation that standardise the statistics.
    """

    scale: tuple[np.ndarray, np.ndarray]
    means: np.ndarray
    factors: np.ndarray  # inverse Cholesky factors
    constants: np.ndarray  # log prior minus half the log determinant

    def log_odds(self, values: np.ndarray) -> np.ndarray:
        z = (values - self.scale[0]) / self.scale[1]
        density = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            distance = (z - mean) @ factor.T
            density.append(constant - 0.5 * (distance**2).sum(axis=1))
        return density[1] - density[0]

    def score(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(values), -500, 500)))


def fit_discriminant(
    labelled: DataFrame, pooled_share: float = 0.2, ridge: float = 0.02
) -> QuadraticDiscriminant:
    """Fit on all rows of ``label`` (0 or 1) and ``statistics``.

    A class covariance is shrunk by ``pooled_share`` towards the covariance within classes,
    then by ``ridge`` towards its own mean variance. A class without rows takes the other's
    figures, so scores are 0.5; without any rows scores are 0.5 too.
    """
    size = len(STATISTICS)
    rows = labelled.select("label", "statistics").where("label in (0, 1)")
    partial = rows.mapInArrow(_moment_rows, "label int, moments array<double>")
    sums = array_sums(partial, "label", "moments", 2)
    if not sums:
        sums = {0: np.zeros(1 + size + size * size)}
    either = next(iter(sums.values()))
    per_class = [sums.get(label, either) for label in (0, 1)]
    counts = np.array([max(one[0], 1.0) for one in per_class])
    means = np.array([one[1 : 1 + size] / n for one, n in zip(per_class, counts)])
    covariances = np.array(
        [
            one[1 + size :].reshape(size, size) / n - np.outer(mean, mean)
            for one, n, mean in zip(per_class, counts, means)
        ]
    )
    total = counts / counts.sum()
    centre = total @ means
    pooled = np.tensordot(total, covariances, 1)
    between = (means - centre).T @ (total[:, None] * (means - centre))
    deviation = np.sqrt(np.maximum(np.diag(pooled + between), 0))
    deviation = np.where(deviation > 1e-9, deviation, 1.0)
    stretch = np.outer(deviation, deviation)
    factors, constants = [], []
    for covariance, share in zip(covariances, total):
        shrunk = (1 - pooled_share) * covariance / stretch + pooled_share * pooled / stretch
        level = max(np.trace(shrunk) / size, 1e-3)
        shrunk = (1 - ridge) * shrunk + ridge * level * np.eye(size)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log(share) - np.log(np.diag(lower)).sum())
    return QuadraticDiscriminant(
        (centre, deviation), (means - centre) / deviation, np.array(factors), np.array(constants)
    )


def _score_rows(batches, model: QuadraticDiscriminant):
    for batch in batches:
        if not batch.num_rows:
            continue
        last = batch.num_columns - 1
        scores = model.score(np.array(batch.column(last).to_pylist()))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(scores, pa.float64())],
            names=[*batch.schema.names[:-1], "score"],
        )


def score_quality(stats: DataFrame, model: QuadraticDiscriminant) -> DataFrame:
    """Replace ``statistics`` (the last column) by ``score``, the probability of label 1."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema[:-1])
    return stats.mapInArrow(lambda batches: _score_rows(batches, model), f"{schema}, score double")
