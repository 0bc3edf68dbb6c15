"""Style and lexicon features of a text, and the rule-based risk score over them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textrisk.functions import fixed
from textrisk.functions.text import as_column


@dataclass(frozen=True)
class Lexicon:
    """Stems match the beginning of a word, words match whole words; case is ignored."""

    profanity_stems: Sequence[str] = fixed.PROFANITY_STEMS
    profanity_words: Sequence[str] = ()
    hostile_stems: Sequence[str] = fixed.HOSTILE_STEMS
    hostile_words: Sequence[str] = fixed.HOSTILE_WORDS


def lexicon_pattern(stems: Sequence[str], words: Sequence[str]) -> str | None:
    """One pattern that matches each listed word once; null when the lists are empty."""
    options = []
    if stems:
        options.append(f"(?:{_any_of(stems)})[{fixed.WORD}]*")
    if words:
        options.append(f"(?:{_any_of(words)})(?![{fixed.WORD}])")
    return f"(?iu)(?<![{fixed.WORD}])(?:{'|'.join(options)})" if options else None


def _any_of(entries: Sequence[str]) -> str:
    return "|".join(rf"\Q{entry}\E" for entry in entries)


#: Entries whose letters have the same case forms one by one and in a text.
_PLAIN = re.compile("[A-Za-zА-Яа-яЁё]+")


def fold_case(text: Column | str) -> Column:
    """Capitals. The dotted capital I and the Kelvin sign, which patterns take for an I and a K
    too, become those."""
    capitals = F.upper(as_column(text))
    return F.replace(F.replace(capitals, F.lit("\u0130"), F.lit("I")), F.lit("\u212a"), F.lit("K"))


def count_listed(text: Column | str, stems: Sequence[str], words: Sequence[str]) -> Column:
    """Matches of ``lexicon_pattern``. A text that holds none of the entries without regard to
    case has none; this search is much cheaper than the pattern."""
    text, entries = as_column(text), [*stems, *words]
    found = count_matches(text, lexicon_pattern(stems, words))
    if not entries or not all(map(_PLAIN.fullmatch, entries)):
        return found
    folded = fold_case(text)
    holds = reduce(lambda a, b: a | b, [F.contains(folded, F.lit(one.upper())) for one in entries])
    return F.when(holds, found).when(text.isNotNull(), F.lit(0))


def count_matches(text: Column | str, pattern: str | None) -> Column:
    if pattern is None:
        return F.lit(0)
    return F.regexp_count(as_column(text), F.lit(pattern))


def count_literal(text: Column | str, mark: str) -> Column:
    text = as_column(text)
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def caps_ratio(text: Column | str) -> Column:
    """Upper-case letters as a share of all letters; 0.0 for a text without letters."""
    letters = F.regexp_replace(as_column(text), r"\P{L}+", "")
    upper = F.regexp_replace(as_column(text), r"\P{Lu}+", "")
    return F.coalesce(F.try_divide(F.length(upper), F.length(letters)), F.lit(0.0))


def shouted_words(text: Column | str) -> Column:
    """Whole words of four or more capitals."""
    word = fixed.WORD
    # the letter is looked at first: most places fail there
    return count_matches(text, rf"(?={fixed.SHOUTED_LETTER})(?<![{word}]){fixed.SHOUTED_WORD}(?![{word}])")


def feature_columns(text: Column | str, lexicon: Lexicon = Lexicon()) -> dict[str, Column]:
    text = as_column(text)
    return {
        "char_len": F.length(text),
        "word_count": count_matches(text, f"[{fixed.WORD}]+"),
        "profanity_count": count_listed(text, lexicon.profanity_stems, lexicon.profanity_words),
        "hostile_count": count_listed(text, lexicon.hostile_stems, lexicon.hostile_words),
        "exclamation_count": count_literal(text, "!"),
        "question_count": count_literal(text, "?"),
        "caps_ratio": caps_ratio(text),
    }


def clip_upper(value: Column | str, ceiling: float) -> Column:
    return F.least(as_column(value), F.lit(ceiling))


def risk_score(shouted: Column | str | None = None) -> Column:
    """Weighted sum over the feature columns; ``shouted`` adds the all-caps-words term."""
    score = (
        F.col("profanity_count") * F.lit(fixed.PROFANITY_WEIGHT)
        + F.col("hostile_count") * F.lit(fixed.HOSTILE_WEIGHT)
        + clip_upper("exclamation_count", fixed.MARKS_COUNTED) * F.lit(fixed.EXCLAMATION_WEIGHT)
        + clip_upper("question_count", fixed.MARKS_COUNTED) * F.lit(fixed.QUESTION_WEIGHT)
        + clip_upper(F.col("caps_ratio") * F.lit(fixed.CAPS_WEIGHT), fixed.CAPS_CEILING)
    )
    if shouted is not None:
        score = score + as_column(shouted) * F.lit(fixed.SHOUTED_WORD_WEIGHT)
    return score


def add_features(
    df: DataFrame,
    text: str = "text",
    lexicon: Lexicon = Lexicon(),
    count_shouted: bool = False,
) -> DataFrame:
    """Append the seven features and ``risk_score``. A plain projection: no shuffle, no UDF."""
    columns = feature_columns(text, lexicon)
    if count_shouted:
        columns["all_caps_words"] = shouted_words(text)
    return df.withColumns(columns).withColumn(
        "risk_score", risk_score("all_caps_words" if count_shouted else None)
    )


def to_number(value: Column | str, default: float | None = 0.0) -> Column:
    """Numeric reading of a column; what is no number becomes ``default``."""
    number = as_column(value).try_cast("double")
    fallback = F.lit(default).cast("double")
    return F.when(number.isNull() | F.isnan(number), fallback).otherwise(number)


def round_for_sink(value: Column | str, places: int = 4) -> Column:
    return F.bround(as_column(value), places)
