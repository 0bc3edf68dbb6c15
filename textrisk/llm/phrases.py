"""Frequent phrases and their collocation scores, found by Rabin-Karp fingerprints.

Texts fall into pieces at punctuation and line breaks, pieces into words. Prefix polynomials over
the hashes of a slice's words give the fingerprint of the phrase at every place. Phrases are
counted by size: one of ``n`` words is counted only where both its parts of ``n - 1`` words are
frequent, as a phrase is never more frequent than its parts. What is frequent is told to the next
pass by a bit filter of bounded size. It lets through every frequent fingerprint and a few others;
one too small for its entries lets through more.

A task counts fingerprints before they are shuffled. With each goes an occurrence pointer (a
number of its text; the smallest is kept) and a few bits of a second hash. Phrases are read from
the texts that the pointers of frequent fingerprints name, and nowhere else. A fingerprint whose
second hashes or phrases differ belongs to several phrases: its occurrences are counted again by
their text.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textrisk.llm.words import (
    WordClass,
    Words,
    _power_tables,
    find_words,
    mix,
    small_batches,
    text_bytes,
)
from textrisk.operators.lookups import join_lookup
from textrisk.session import staged

MOST_WORDS = 5
LEAST_COUNT = 100
#: Language of texts without one.
UNKNOWN = "und"

#: Bytes of text worked on at once; a longer text is cut between pieces.
CHUNK_BYTES = 2 << 20
# Fingerprints, or phrases, that a task collects before it hands them on.
_BUFFER = 1 << 21
_PHRASES = 1 << 18
#: Bits of a filter: per entry, and at most (16 MB). The driver gets it in blocks.
FILTER_BITS = 16
MOST_BITS = 1 << 27
_BLOCK = 19
_PROBES = (np.uint64(0), np.uint64(18), np.uint64(36))
# A count, bits of a second hash and a pointer share one number.
_COUNT_BITS, _CHECK_BITS, _POINTER_BITS = 22, 16, 25

_BREAKS = frozenset(b".,;:!?\n\x0b\x0c\r")
_IS_BREAK = np.array([b in _BREAKS for b in range(256)])
_LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
PHRASE_WORDS = WordClass(lambda b: b not in b" \t" and b not in _BREAKS)


def chunks(data: np.ndarray, bounds: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple]:
    """Bytes of about ``size`` each, where their texts or parts of a text begin, and the number
    of each one's text. A text is cut only behind a break, so no piece is."""
    begin, total = 0, len(data)
    while begin < total:
        end = min(begin + size, total)
        text = int(np.searchsorted(bounds, end, "right")) - 1
        if end < total and bounds[text] > begin:
            end = int(bounds[text])
        elif end < total:
            stop = int(bounds[text + 1])
            inside = np.flatnonzero(_IS_BREAK[data[begin:end]])
            if len(inside):
                end = begin + int(inside[-1]) + 1
            else:
                behind = _IS_BREAK[data[end:stop]]
                end = end + int(behind.argmax()) + 1 if behind.any() else stop
        first = int(np.searchsorted(bounds, begin, "right"))
        last = int(np.searchsorted(bounds, end, "left"))
        cuts = np.concatenate([[begin], bounds[first:last], [end]])
        yield data[begin:end], cuts - begin, np.searchsorted(bounds, cuts[:-1], "right") - 1
        begin = end


@dataclass(frozen=True)
class Pieces:
    """Words of a chunk, each one's text, a number that differs from piece to piece, the number
    of its language, and the pointer, a number that equal texts (or parts of a text) share."""

    data: np.ndarray
    words: Words
    text: np.ndarray
    piece: np.ndarray
    language: np.ndarray
    pointer: np.ndarray

    def places(self, size: int) -> np.ndarray:
        """Words at which a phrase of so many words begins."""
        last = len(self.piece) - size + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[:last] == self.piece[size - 1 :])


def cut_pieces(data: np.ndarray, cuts: np.ndarray, texts: np.ndarray, languages: np.ndarray) -> Pieces:
    """``languages`` has the number of each text's language."""
    words = find_words(data, cuts, PHRASE_WORDS)
    part = np.repeat(np.arange(len(texts)), np.diff(words.first))
    breaks = np.cumsum(_IS_BREAK[data])
    text = texts[part]
    sums = np.append(np.uint64(0), np.cumsum(words.hashes))
    pointers = mix(sums[words.first[1:]] - sums[words.first[:-1]]) >> np.uint64(64 - _POINTER_BITS)
    return Pieces(data, words, text, breaks[words.starts] + part, languages[text], pointers[part])


def language_code(name: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little"))


class Fingerprints:
    """Fingerprints of the phrases of a chunk, by prefix polynomials over its words' hashes.

    They differ by language (``codes``, one per language) and size. ``bits`` keeps the lowest ones
    only, for tests of collisions.
    """

    def __init__(self, pieces: Pieces, codes: np.ndarray, bits: int = 64):
        self.pieces, self.bits = pieces, np.uint64((1 << bits) - 1)
        hashes = pieces.words.hashes & self.bits
        self.power, self.inverse = _power_tables(len(hashes) + 1)
        self.sums = self._prefix(hashes)
        self.codes = codes[pieces.language]

    def _prefix(self, hashes: np.ndarray) -> np.ndarray:
        return np.append(np.uint64(0), np.cumsum(hashes * self.power[: len(hashes)]))

    def _at(self, sums: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
        plain = (sums[places + size] - sums[places]) * self.inverse[places]
        return mix(mix(plain + np.uint64(size)) + self.codes[places])

    def at(self, places: np.ndarray, size: int) -> np.ndarray:
        return self._at(self.sums, places, size) & self.bits

    def checks(self, places: np.ndarray, size: int) -> np.ndarray:
        """A few bits of a second fingerprint."""
        second = self._prefix(mix(~self.pieces.words.hashes))
        return self._at(second, places, size) >> np.uint64(64 - _CHECK_BITS)


@dataclass(frozen=True)
class BitFilter:
    """Three bits per entry. Every entry is found, others seldom while there is room."""

    bits: np.ndarray

    def has(self, values: np.ndarray) -> np.ndarray:
        found = np.ones(len(values), bool)
        for place in _filter_places(values, 8 * len(self.bits)):
            found &= (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
        return found


def _filter_places(values: np.ndarray, size: int) -> list[np.ndarray]:
    spread = mix(values)
    return [((spread >> shift) & np.uint64(size - 1)).astype(np.int64) for shift in _PROBES]


def bit_filter(entries: DataFrame, most_bits: int = MOST_BITS) -> BitFilter:
    """A filter of the 64-bit numbers of a staged frame of one column. Each task fills whole
    blocks of it; the driver gets the filter, never the entries."""
    wanted = max(entries.count(), 1) * FILTER_BITS
    size = min(1 << max(_BLOCK, (wanted - 1).bit_length()), most_bits)

    def deal(batches):
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            places = np.concatenate(_filter_places(values, size))
            columns = [pa.array(places >> _BLOCK), pa.array(places)]
            yield pa.RecordBatch.from_arrays(columns, ["block", "place"])

    def fill(batches):
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            numbers, places = (batch.column(i).to_numpy() for i in (0, 1))
            for number in np.unique(numbers).tolist():
                marks = blocks.setdefault(number, np.zeros(min(1 << _BLOCK, size), bool))
                marks[places[numbers == number] & ((1 << _BLOCK) - 1)] = True
        for number, marks in blocks.items():
            packed = np.packbits(marks, bitorder="little").tobytes()
            yield pa.RecordBatch.from_pydict({"block": [number], "marks": [packed]})

    dealt = entries.mapInArrow(deal, "block bigint, place bigint")
    parts = min(max(size >> _BLOCK, 1), 64)
    filled = dealt.repartition(parts, "block").mapInArrow(fill, "block bigint, marks binary")
    bits = np.zeros(size >> 3, np.uint8)
    for row in filled.collect():  # most_bits / 8 bytes together
        begin = row.block << (_BLOCK - 3)
        bits[begin : begin + len(row.marks)] |= np.frombuffer(row.marks, np.uint8)
    return BitFilter(bits)


def _read(batch, bits: int, chunk_bytes: int) -> Iterator[tuple[Pieces, Fingerprints, list[str]]]:
    """Chunks of a batch with columns lang, text; and the names of its languages."""
    coded = batch.column(0).dictionary_encode()
    names = coded.dictionary.to_pylist()
    codes = np.array([language_code(name) for name in names], np.uint64)
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    data, bounds = text_bytes(batch.column(1))
    for part, cuts, texts in chunks(data, bounds, chunk_bytes):
        pieces = cut_pieces(part, cuts, texts, numbers)
        yield pieces, Fingerprints(pieces, codes, bits), names


def _candidates(prints: Fingerprints, size: int, known: BitFilter | None) -> np.ndarray:
    """Places of phrases whose parts of one word less may be frequent."""
    places = prints.pieces.places(size)
    if known is None or not len(places):
        return places
    places = places[known.has(prints.at(places, size - 1))]
    return places[known.has(prints.at(places + 1, size - 1))]


def _count_prints(batches, size: int, known, bits: int, chunk_bytes: int):
    filter_ = known.value if known is not None else None
    held: list[tuple[np.ndarray, ...]] = []
    room = _BUFFER

    def combined():
        values, checks, pointers = (np.concatenate(column) for column in zip(*held))
        held.clear()
        # One row for equal fingerprints; those whose second hash differs keep rows of their own.
        values, first, number, counts = np.unique(
            values, return_index=True, return_inverse=True, return_counts=True
        )
        other = np.flatnonzero(checks != checks[first][number])
        counts -= np.bincount(number[other], minlength=len(values))
        values = np.concatenate([values, values[number[other]]])
        kept = np.concatenate([first, other])
        rest = checks[kept] | pointers[kept] << np.uint64(_CHECK_BITS)
        counts = np.concatenate([counts, np.ones(len(other), np.int64)])
        most = (1 << _COUNT_BITS) - 1
        again = counts // most + (counts % most > 0)  # rows for one fingerprint, mostly one
        if (again != 1).any():
            index = np.repeat(np.arange(len(counts)), again)
            last = np.append(index[1:] != index[:-1], True)
            counts = np.where(last, counts[index] - most * (again[index] - 1), most)
            values, rest = values[index], rest[index]
        packed = rest << np.uint64(_COUNT_BITS) | counts.astype(np.uint64)
        for begin in range(0, len(values), 1 << 16):
            columns = [pa.array(c[begin : begin + (1 << 16)].view(np.int64)) for c in (values, packed)]
            yield pa.RecordBatch.from_arrays(columns, ["print", "packed"])

    for batch in batches:
        for pieces, prints, _ in _read(batch, bits, chunk_bytes):
            places = _candidates(prints, size, filter_)
            held.append((prints.at(places, size), prints.checks(places, size), pieces.pointer[places]))
            room -= len(places)
            if room <= 0:
                yield from combined()
                room = _BUFFER
    if held:
        yield from combined()


def _summed(counted: DataFrame, least: int) -> DataFrame:
    """``print``, ``n``, ``pointer``, and whether different second hashes ``clash``."""
    count = F.col("packed").bitwiseAND(F.lit((1 << _COUNT_BITS) - 1))
    check = F.shiftright("packed", _COUNT_BITS).bitwiseAND(F.lit((1 << _CHECK_BITS) - 1))
    # Tasks have counted already: dealt by fingerprint first, rows are not hashed a second time.
    sums = counted.repartition("print").groupBy("print").agg(
        F.sum(count).alias("n"),
        F.min(F.shiftright("packed", _COUNT_BITS + _CHECK_BITS)).alias("pointer"),
        (F.min(check) < F.max(check)).alias("clash"),
    )
    return sums.where(F.col("n") >= least)


def _pointed(values: np.ndarray, pointers: np.ndarray) -> np.ndarray:
    """A number for a fingerprint in a text."""
    return mix(values) + pointers


def _exact_words(pieces: Pieces, bits: np.uint64) -> np.ndarray:
    """A number per word that is the same for equal words only: each word is compared, byte by
    byte, with the first one of its hash."""
    words, data = pieces.words, _LOWERED[pieces.data]
    _, first, number = np.unique(words.hashes & bits, return_index=True, return_inverse=True)
    lengths = words.ends - words.starts
    model = first[number]
    same = lengths == lengths[model]
    checked = np.where(same, lengths, 0)
    offsets = np.arange(checked.sum()) - np.repeat(np.cumsum(checked) - checked, checked)
    equal = data[np.repeat(words.starts, checked) + offsets] == data[
        np.repeat(words.starts[model], checked) + offsets
    ]
    if equal.all() and same.all():
        return number
    seen: dict[bytes, int] = {}
    return np.array(
        [seen.setdefault(data[a:b].tobytes(), len(seen)) for a, b in zip(words.starts, words.ends)]
    )


_PHRASE_ROWS = "print bigint, lang string, size int, phrase string, n bigint"


def _read_phrases(batches, filters, chosen, with_pointer: bool, bits: int, chunk_bytes: int, schema):
    """The phrases whose fingerprint is ``chosen`` (with the pointer of the text they stand in,
    if ``with_pointer``) and how often each is there; with size 0 each language's words."""
    known, wanted = filters.value, chosen.value
    found: Counter = Counter()

    def rows():
        keys = list(found)
        columns = [[key[i] for key in keys] for i in range(4)] + [[found[key] for key in keys]]
        found.clear()
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
        )

    for batch in batches:
        for pieces, prints, names in _read(batch, bits, chunk_bytes):
            if not len(pieces.text):
                continue
            for language, count in enumerate(np.bincount(pieces.language).tolist()):
                found[0, names[language], 0, ""] += count
            exact = _exact_words(pieces, prints.bits)
            raw = _LOWERED[pieces.data].tobytes()
            starts, ends = pieces.words.starts, pieces.words.ends

            def add(place: int, value: int, size: int, count: int) -> None:
                words = range(place, place + size)
                phrase = b" ".join(raw[starts[i] : ends[i]] for i in words).decode()
                found[value, names[pieces.language[place]], size, phrase] += count

            for size in range(1, len(known) + 1):
                places = _candidates(prints, size, known[size - 2] if size > 1 else None)
                values = prints.at(places, size)
                marked = _pointed(values, pieces.pointer[places]) if with_pointer else values
                inside = known[size - 1].has(values) & wanted.has(marked)
                places, values = places[inside], values[inside]
                _, first, number = np.unique(values, return_index=True, return_inverse=True)
                model = places[first]
                same = pieces.language[places] == pieces.language[model][number]
                for step in range(size):
                    same &= exact[places + step] == exact[model + step][number]
                counts = np.bincount(number[same], minlength=len(model))
                whole = values.view(np.int64)
                for place, value, count in zip(model.tolist(), whole[first].tolist(), counts.tolist()):
                    add(place, value, size, count)
                for place, value in zip(places[~same].tolist(), whole[~same].tolist()):  # collisions
                    add(place, value, size, 1)
            if len(found) >= _PHRASES:
                yield from rows()
    if found:
        yield from rows()


def phrase_counts(
    documents: DataFrame,
    least: int = LEAST_COUNT,
    most_words: int = MOST_WORDS,
    *,
    bits: int = 64,
    most_bits: int = MOST_BITS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``lang``, ``size`` (words), ``phrase`` (lower case, joined by one blank) and ``n`` of the
    phrases that occur at least ``least`` times in a language; with size 0 and an empty phrase,
    each language's number of words.

    Needs ``lang`` and ``text``. Null languages are ``und``, null texts empty; further columns
    are ignored; repeated rows count as often as they are there. Different phrases are told
    apart by 80 bits of two hashes, and by their text where it is read.
    """
    spark = documents.sparkSession
    small_batches(spark)
    name = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    texts = documents.select(name.alias("lang"), F.col("text").cast("string").alias("text"))
    known, filters, levels = None, [], []
    for size in range(1, most_words + 1):
        counted = texts.mapInArrow(
            lambda batches, size=size, known=known: _count_prints(batches, size, known, bits, chunk_bytes),
            "print bigint, packed bigint",
        )
        level = staged(_summed(counted, least))
        filters.append(bit_filter(level.select("print"), most_bits))
        levels.append(level.withColumn("size", F.lit(size)))
        known = spark.sparkContext.broadcast(filters[-1])
    every = spark.sparkContext.broadcast(filters)
    schema = pa.schema(
        [("print", pa.int64()), ("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()),
         ("n", pa.int64())]
    )
    frequent = levels[0]
    for level in levels[1:]:
        frequent = frequent.unionByName(level)

    def read(chosen: DataFrame, with_pointer: bool) -> DataFrame:
        wanted = spark.sparkContext.broadcast(bit_filter(chosen, most_bits))
        return texts.mapInArrow(
            lambda batches: _read_phrases(batches, every, wanted, with_pointer, bits, chunk_bytes, schema),
            _PHRASE_ROWS,
        )

    def mark(batches):
        for batch in batches:
            values, pointers = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(_pointed(values, pointers).view(np.int64))], ["mark"])

    marks = staged(frequent.where("not clash").select("print", "pointer").mapInArrow(mark, "mark bigint"))
    rows = read(marks, True).groupBy("print", "size", "lang", "phrase")
    texted = staged(rows.agg(F.sum("n").alias("words")))
    one = texted.where("size > 0").groupBy("print", "size").agg(
        F.min(F.struct("lang", "phrase")).alias("low"), F.max(F.struct("lang", "phrase")).alias("high")
    )
    # A fingerprint without a phrase would be counted by text, too.
    clash = F.coalesce(F.col("clash") | (F.col("low") != F.col("high")), F.lit(True))
    found = staged(frequent.join(one, ["print", "size"], "left").withColumn("clash", clash))
    counts = found.where("not clash").select("low.lang", "size", "low.phrase", "n")
    totals = texted.where("size = 0").groupBy("lang", "size", "phrase").agg(F.sum("words").alias("n"))
    counts = counts.unionByName(totals)
    clashes = found.where("clash").select("print", "size")
    if not clashes.isEmpty():
        again = read(staged(clashes.select("print")), False).where("size > 0")
        # A filter lets others through, whose phrases are counted already.
        again = again.join(clashes, ["print", "size"], "left_semi")
        summed = again.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
        counts = counts.unionByName(summed.where(F.col("n") >= least))
    return staged(counts)


def _part(first: Column, count: Column) -> Column:
    return F.array_join(F.slice("words", first, count), " ")


def _key(phrase: Column) -> Column:
    """Language and phrase as one key; phrases hold no blank at their end, languages may."""
    return F.concat_ws("\n", phrase, "lang")


def collocations(
    documents: DataFrame,
    least: int = LEAST_COUNT,
    most_words: int = MOST_WORDS,
    best: int = 2000,
    covered: int = 100,
    **settings,
) -> DataFrame:
    """Each language's ``best`` phrases of two words and more: ``lang``, ``rank``, ``phrase``,
    ``a`` (its count), ``l``, ``r`` (counts of its parts at the cut that scores lowest), ``n``
    (words of the language) and ``score``, floor(1000 a n / (l r)).

    Left out are phrases inside a longer one that has ``covered`` percent of their count or
    more. Equal scores are ranked by count, then phrase. Numbers are exact below 10^15
    occurrences of a phrase and 10^16 words; larger ones raise an error. ``settings`` and the
    input are those of ``phrase_counts``.
    """
    counts = phrase_counts(documents, least, most_words, **settings)
    totals = counts.where("size = 0").select("lang", F.col("n").alias("total"))
    phrases = counts.where("size > 0")
    # A phrase is part of longer ones about as often as it is frequent.
    lookup = staged(
        phrases.select(_key(F.col("phrase")).alias("key"), F.col("n").alias("found"), F.col("n").alias("rows"))
    )
    candidates = phrases.where("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = candidates.select(
        "lang", "size", "phrase", "words", "n", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    sides = {"l": _part(F.lit(1), F.col("k")), "r": _part(F.col("k") + 1, F.col("size") - F.col("k"))}
    measured = cuts
    for side, part in sides.items():
        keyed = measured.withColumn("key", _key(part))
        measured = join_lookup(keyed, lookup, "key", "rows").withColumnRenamed("found", side).drop("key")
    # Parts of a frequent phrase are frequent, so every cut has both. A part one word shorter
    # that is as frequent hides inside; a shorter one then hides inside that.
    parts = F.array(*[_key(_part(F.lit(first), F.col("size") - 1)) for first in (1, 2)])
    inner = candidates.where("size > 2").select(F.explode(parts).alias("key"), "n")
    longest = inner.groupBy("key").agg(F.max("n").alias("longer"))
    open_ = candidates.withColumn("key", _key(F.col("phrase"))).join(longest, "key", "left")
    open_ = open_.where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("n") * covered)
    ).select("lang", "phrase")
    digits = {"n": 15, "l": 15, "r": 15, "total": 16}
    number = {name: F.col(name).cast(f"decimal({most},0)") for name, most in digits.items()}
    scored = measured.join(totals, "lang").withColumns(
        {"above": F.lit(1000).cast("decimal(4,0)") * number["n"] * number["total"],
         "below": number["l"] * number["r"]}
    ).withColumn("score", F.expr("above div below"))
    lowest = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "n", "total")).alias("cut")
    )
    rows = lowest.join(open_, ["lang", "phrase"]).select(
        "lang", "phrase", F.col("cut.n").alias("a"), "cut.l", "cut.r", F.col("cut.total").alias("n"),
        "cut.score",
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.where(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
