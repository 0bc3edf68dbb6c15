"""Benchmark decontamination with suffix arrays of the training texts.

The documents are cut into shards (slices of a partition's rows). For each shard the word
suffixes that can begin a match are put in dictionary order, up to the length of a window;
every suffix of the test items is then looked up by binary search, which gives all places
where its first words occur. Matches are extended to their full length by comparing words.

Suffixes whose first words begin no test suffix are left out of the array: no search could
return them. Test items come in blocks of bounded size, each of them sent to all tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textrisk.llm.words import (
    ALPHANUMERIC,
    Words,
    chain,
    find_words,
    slices,
    small_batches,
    text_bytes,
)
from textrisk.session import staged

WINDOW = 10
#: Bytes of test items that are sent to the tasks at once.
BLOCK_BYTES = 8 << 20

# Words by which suffixes are kept or left out, at most.
_LEAD = 3
_FILTER_BITS = 20
_PAIRS = 1 << 21

MATCH_TYPE = "struct<item_id:bigint,start:bigint,item_start:bigint,words:bigint>"
SPAN_TYPE = "struct<start:bigint,end:bigint>"


def _keys(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """The words from each start on as byte strings that sort like the word sequences; what
    lies beyond the end is zero."""
    places = starts[:, None] + np.arange(width)
    inside = places < ends[:, None]
    cells = np.where(inside, words[np.minimum(places, max(len(words) - 1, 0))], np.uint64(0))
    return np.ascontiguousarray(cells.astype(">u8")).view(f"S{8 * width}").ravel()


@dataclass(frozen=True)
class TestSuffixes:
    """Distinct windows of a block of test items in dictionary order, with their places."""

    ids: np.ndarray
    words: np.ndarray  # all items' words, one item after the other
    begins: np.ndarray
    width: int
    keys: np.ndarray  # distinct windows
    lengths: np.ndarray
    first_place: np.ndarray  # per window: its first entry in the two below, and the end
    place_item: np.ndarray
    place_word: np.ndarray
    lead: int
    lead_hashes: np.ndarray

    __test__ = False

    @staticmethod
    def build(items: list[tuple[int, str]], width: int = WINDOW) -> TestSuffixes:
        data, bounds = text_bytes(pa.array([text for _, text in items], pa.large_string()))
        words = find_words(data, bounds, ALPHANUMERIC)
        counts = np.diff(words.first)
        lengths = np.minimum(counts, width)
        windows = np.where(counts > 0, counts - lengths + 1, 0)
        item = np.repeat(np.arange(len(items)), windows)
        offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        start = words.first[:-1][item] + offset
        keys = _keys(words.hashes, start, start + lengths[item], width)
        distinct, number = np.unique(keys, return_inverse=True)
        order = np.argsort(number, kind="stable")
        window_lengths = np.zeros(len(distinct), np.int64)
        window_lengths[number] = lengths[item]
        first_place = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(distinct)))])
        lead = int(min(lengths[item].min(initial=_LEAD), _LEAD))
        leads = chain(words.hashes, lead)
        return TestSuffixes(
            np.array([item_id for item_id, _ in items], np.int64), words.hashes, words.first,
            width, distinct, window_lengths, first_place, item[order], offset[order], lead,
            np.unique(leads[start]) if len(start) else leads[:0],
        )

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """All places where a window occurs in a shard: word numbers and window numbers."""
        none = np.zeros(0, np.int64)
        if not len(self.keys) or len(words.hashes) < self.lead:
            return none, none
        mask = np.uint64((1 << _FILTER_BITS) - 1)
        wanted = np.zeros(1 << _FILTER_BITS, bool)
        wanted[(self.lead_hashes & mask).astype(np.int64)] = True
        leads = chain(words.hashes, self.lead)
        suffixes = np.flatnonzero(wanted[(leads & mask).astype(np.int64)])
        suffixes = suffixes[np.isin(leads[suffixes], self.lead_hashes)]
        ends = words.first[np.searchsorted(words.first, suffixes, "right")]
        keys = _keys(words.hashes, suffixes, ends, self.width)
        order = np.argsort(keys, kind="stable")
        suffixes, keys = suffixes[order], keys[order]
        # Everything that begins with a window lies between it and it filled up with the
        # greatest words.
        cells = self.keys.view(">u8").reshape(len(self.keys), self.width)
        beyond = np.arange(self.width) >= self.lengths[:, None]
        upper = np.where(beyond, np.uint64(2**64 - 1), cells).astype(">u8")
        upper = np.ascontiguousarray(upper).view(f"S{8 * self.width}").ravel()
        lo = np.searchsorted(keys, self.keys, "left")
        hi = np.searchsorted(keys, upper, "right")
        found = hi - lo
        window = np.repeat(np.arange(len(self.keys)), found)
        rank = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found)
        return suffixes[lo[window] + rank], window

    def longest(self, words: Words, places: np.ndarray, windows: np.ndarray):
        """Matches that cannot be made longer: text, item, first word in each, and words."""
        occurrences = np.diff(self.first_place)[windows]
        ends = np.cumsum(occurrences)
        found = []
        begin = 0
        while begin < len(places):
            done = ends[begin] - occurrences[begin]
            stop = max(int(np.searchsorted(ends, done + _PAIRS, "right")), begin + 1)
            count = occurrences[begin:stop]
            place = np.repeat(places[begin:stop], count)
            rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            entry = np.repeat(self.first_place[windows[begin:stop]], count) + rank
            item = self.place_item[entry]
            at = self.begins[item] + self.place_word[entry]
            text = np.searchsorted(words.first, place, "right") - 1
            # A match that the word before it also belongs to is found from that word.
            inner = (self.place_word[entry] > 0) & (place > words.first[text])
            inner &= words.hashes[place - 1] == self.words[at - 1]
            length = np.repeat(self.lengths[windows[begin:stop]], count)
            text, item, place, at, length = (x[~inner] for x in (text, item, place, at, length))
            most = np.minimum(words.first[text + 1] - place, self.begins[item + 1] - at)
            open_ = np.flatnonzero(length < most)
            while len(open_):
                same = (
                    words.hashes[place[open_] + length[open_]] == self.words[at[open_] + length[open_]]
                )
                open_ = open_[same]
                length[open_] += 1
                open_ = open_[length[open_] < most[open_]]
            found.append((text, item, place - words.first[text], at - self.begins[item], length))
            begin = stop
        return [np.concatenate(part) for part in zip(*found)] if found else None


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _scan_rows(batches, suffixes: TestSuffixes, schema: pa.Schema):
    """Adds a block's findings to the rows; columns: text, doc_id, n_words, spans, items,
    matches."""
    for batch in batches:
        for begin, end in slices(batch.column(0)):
            part = batch.slice(begin, end - begin)
            data, bounds = text_bytes(part.column(0))
            words = find_words(data, bounds, ALPHANUMERIC)
            places, windows = suffixes.search(words)
            rows = part.to_pydict()
            rows["n_words"] = np.diff(words.first).tolist()
            if len(places):
                texts = np.searchsorted(words.first, places, "right") - 1
                starts = places - words.first[texts]
                stops = starts + suffixes.lengths[windows]
                for text in np.unique(texts):
                    own = texts == text
                    old = [(s["start"], s["end"]) for s in rows["spans"][text]]
                    pairs = _merged(old + list(zip(starts[own].tolist(), stops[own].tolist())))
                    rows["spans"][text] = [{"start": s, "end": e} for s, e in pairs]
                for text, item, start, item_start, length in zip(
                    *(x.tolist() for x in suffixes.longest(words, places, windows))
                ):
                    item_id = int(suffixes.ids[item])
                    rows["matches"][text].append(
                        {"item_id": item_id, "start": start, "item_start": item_start, "words": length}
                    )
                    rows["items"][text].append(item_id)
                for text in np.unique(texts):
                    rows["items"][text] = sorted(set(rows["items"][text]))
            yield pa.RecordBatch.from_pydict(
                {name: rows[name] for name in schema.names}, schema=schema
            )


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Test items with id and text, some megabytes at a time."""
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("item_id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield block, blocks, [(row.item_id, row.text) for row in mine.collect()]


def find_overlaps(
    documents: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``spans`` (word ranges inside some occurrence of a
    window, merged), ``items`` (ids of items with an occurring window, ascending) and
    ``matches`` (longest verbatim matches of a window or more, with both places).

    A window is ``width`` consecutive words of an item; a shorter item is one window. Null
    and empty texts have no words. Items without id or text are left out, repeated items count
    once. Every row of ``documents`` gives one row, repeated ones too; further columns are
    ignored.
    """
    small_batches(documents.sparkSession)
    rows = documents.select(
        F.col("text").cast("string").alias("text"),
        F.col("doc_id"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(f"array<{SPAN_TYPE}>").alias("spans"),
        F.array().cast("array<bigint>").alias("items"),
        F.array().cast(f"array<{MATCH_TYPE}>").alias("matches"),
    )
    schema = rows.schema
    blocks = _blocks(benchmark, block_bytes)
    for block, count, items in [next(blocks, (0, 1, []))]:
        rows = _scan(rows, items, width, schema)
    for block, count, items in blocks:
        rows = _scan(staged(rows), items, width, schema)
    return rows.drop("text")


def _scan(rows: DataFrame, items, width: int, schema: T.StructType) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    suffixes, arrow = TestSuffixes.build(items, width), to_arrow_schema(schema)
    return rows.mapInArrow(lambda batches: _scan_rows(batches, suffixes, arrow), schema)


def _clean_rows(batches, suffixes: TestSuffixes, text: int):
    for batch in batches:
        for begin, end in slices(batch.column(text)):
            part = batch.slice(begin, end - begin)
            data, bounds = text_bytes(part.column(text))
            words = find_words(data, bounds, ALPHANUMERIC)
            places, _ = suffixes.search(words)
            clean = np.ones(end - begin, bool)
            clean[np.searchsorted(words.first, places, "right") - 1] = False
            yield part.filter(pa.array(clean))


def remove_overlapping(
    documents: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``documents`` in whose ``text`` no window of a test item occurs, with all
    their columns. One pass over the documents for each block of items."""
    small_batches(documents.sparkSession)
    text = documents.columns.index("text")
    kept = documents
    # Nothing is told of the items, so those without id are searched too.
    named = benchmark.select(
        F.coalesce(F.col("item_id").cast("bigint"), F.lit(0)).alias("item_id"), "text"
    )
    for block, _, items in _blocks(named, block_bytes):
        suffixes = TestSuffixes.build(items, width)
        source = kept if block == 0 else staged(kept)
        kept = source.mapInArrow(
            lambda batches, found=suffixes: _clean_rows(batches, found, text), documents.schema
        )
    return kept
