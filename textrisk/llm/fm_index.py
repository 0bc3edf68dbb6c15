"""Words within one edit of each other, by an FM-index over a delimited vocabulary.

The index is the Burrows-Wheeler transform of all words, each between delimiters. The suffixes
that begin with a string lie side by side in dictionary order, so a string is a pair of ranks,
and a character put before it gives the new pair by two rank lookups. The search scheme for one
edit matches one part of the word exactly, character by character from the outer end, and goes on
across the other part with one character replaced, left out or put in between.

Reading words from the right end, the index extends strings to the left: the last part is
matched exactly. Over reversed words the same index extends strings to the right, and the first
part is matched exactly. With one edit, each search runs in one direction only, so the two
indexes need not be kept in step.

All searches of an index go on side by side: a state is a word, how much of it is matched, and
the interval of ranks; a step works on all states that have matched as much.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def _points(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after the other, and the words' lengths."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return points, np.array([len(word) for word in words], np.int64)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of ranges with these starts and lengths, one range after the other."""
    total = int(counts.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


class VocabularyIndex:
    """Index over different words, which must be sorted by ``codes`` order (code points).

    ``words`` are strings. Rank ``k`` of a suffix that begins with the delimiter in front of a
    word is the number of that word.
    """

    def __init__(self, words: Sequence[str]):
        self.count = len(words)
        points, lengths = _points(words)
        self.letters, codes = np.unique(points, return_inverse=True)
        #: Code 0 is the delimiter.
        self.size = len(self.letters) + 1
        self.begins = np.cumsum(lengths) - lengths + np.arange(1, self.count + 1)
        self.lengths = lengths
        # A ring: the delimiter in front of the first word also ends the last one.
        self.text = np.zeros(int(lengths.sum()) + self.count, np.int32)
        self.text[_ranges(self.begins, lengths)] = codes + 1
        order = self._suffixes()
        self.transform = self.text[order - 1]
        # Sorted by character, then rank: the place of (c, i) is the rank that i has before c.
        self.keys = np.sort(self.transform.astype(np.int64) * (len(order) + 1) + np.arange(len(order)))
        self.rank_of = np.empty(len(order), np.int64)
        self.rank_of[np.argsort(self.transform, kind="stable")] = np.arange(len(order))

    def _suffixes(self) -> np.ndarray:
        """Places of the suffixes in dictionary order, each read up to its delimiter; equal
        ones in the order of the words behind it."""
        inside = _ranges(self.begins, self.lengths)
        word = np.repeat(np.arange(self.count), self.lengths)
        behind = np.zeros(len(self.text), np.int64)
        behind[self.begins - 1] = np.arange(self.count)
        behind[inside] = (word + 1) % max(self.count, 1)
        left = np.zeros(len(self.text), np.int64)  # characters up to the delimiter
        left[inside] = (self.begins + self.lengths)[word] - inside
        rank = self.text.astype(np.int64)
        places = np.arange(len(rank))
        width = 1
        while width <= int(self.lengths.max(initial=0)):
            next_ = np.where(left > width, rank[np.minimum(places + width, len(rank) - 1)] + 1, left == width)
            _, rank = np.unique(rank * (int(rank.max()) + 2) + next_, return_inverse=True)
            width *= 2
        return np.lexsort((behind, rank))

    def extend(self, low: np.ndarray, high: np.ndarray, code: np.ndarray) -> tuple:
        """Intervals of the strings with ``code`` (one each) put in front."""
        base = code.astype(np.int64) * (len(self.text) + 1)
        return np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)

    def extend_all(self, low: np.ndarray, high: np.ndarray) -> tuple:
        """For all characters that stand before the strings: number of the interval, code, and
        the new interval. The delimiter is left out."""
        width = high - low
        narrow = np.flatnonzero(width <= self.size)
        # Read the characters in front of each suffix; equal ones of an interval form a new one.
        owner = np.repeat(narrow, width[narrow])
        ranks = _ranges(low[narrow], width[narrow])
        keyed = owner * self.size + self.transform[ranks]
        order = np.argsort(keyed, kind="stable")
        ordered = keyed[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else order
        counts = np.diff(np.append(first, len(ordered)))
        begin = self.rank_of[ranks[order[first]]]
        parts = [(ordered[first] // self.size, ordered[first] % self.size, begin, begin + counts)]
        wide = np.flatnonzero(width > self.size)
        if len(wide):
            owner = np.repeat(wide, self.size - 1)
            code = np.tile(np.arange(1, self.size), len(wide))
            parts.append((owner, code, *self.extend(low[owner], high[owner], code)))
        owner, code, begin, end = (np.concatenate(column) for column in zip(*parts))
        kept = (end > begin) & (code > 0)
        return owner[kept], code[kept], begin[kept], end[kept]

    def near(self, queries: Sequence[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of the number of a query and that of a word of the index, made from it by one
        edit left of its last ``exact`` characters. Each pair once."""
        if not len(queries) or not self.count:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        points, lengths = _points(queries)
        place = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        # No suffix has a character that the index does not know in front.
        codes = np.where(self.letters[place] == points, place + 1, -1)
        last = np.cumsum(lengths) - 1
        number = np.arange(len(queries))
        low = np.zeros(len(queries), np.int64)
        high = np.full(len(queries), self.count)  # all suffixes that begin with a delimiter
        edited = (number[:0], low[:0], high[:0])  # number, low, high
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for step in range(int(lengths.max()) + 1):
            # Words without an edit so far: try one here.
            open_ = exact[number] <= step
            one, one_low, one_high = number[open_], low[open_], high[open_]
            owner, code, begin, end = self.extend_all(one_low, one_high)
            owner = one[owner]
            states = [edited, (owner, begin, end)]  # a character more
            inner = lengths[owner] > step
            owner, code, begin, end = owner[inner], code[inner], begin[inner], end[inner]
            other = code != codes[last[owner] - step]
            after = [(owner[other], begin[other], end[other])]  # another character
            inner = lengths[one] > step
            after.append((one[inner], one_low[inner], one_high[inner]))  # a character less
            # Words with an edit: read on, or stop before the delimiter.
            who, who_low, who_high = (np.concatenate(column) for column in zip(*states))
            done = lengths[who] == step
            begin, end = self.extend(who_low[done], who_high[done], np.zeros(int(done.sum()), np.int64))
            found.append((np.repeat(who[done], end - begin), _ranges(begin, end - begin)))
            who, who_low, who_high = who[~done], who_low[~done], who_high[~done]
            after.append(self._some(who, *self.extend(who_low, who_high, codes[last[who] - step])))
            edited = tuple(np.concatenate(column) for column in zip(*after))
            # Words without an edit read on.
            more = lengths[number] > step
            number, low, high = number[more], low[more], high[more]
            number, low, high = self._some(number, *self.extend(low, high, codes[last[number] - step]))
        query, word = (np.concatenate(column) for column in zip(*found))
        pairs = np.unique(query * self.count + word)
        return pairs // self.count, pairs % self.count

    @staticmethod
    def _some(number: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
        """The states whose interval is not empty."""
        kept = high > low
        return number[kept], low[kept], high[kept]
