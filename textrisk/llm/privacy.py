r"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

E-mail addresses, IP addresses, card and phone numbers found by pattern are the protected
entities. A word near an entity reveals it when knowing the word makes the entity likely. The
corpus says how strongly:

* support: the number of different surroundings in which word and entity occur together
  (copies of one passage count once),
* disclosure: the share of the documents with the word in which it stands near the entity,
* information: the logarithm of how much more often the word stands near the entity than its
  share of all documents would have it.

Evidence is counted per window: what stands further from an entity than its surroundings says
nothing about it. Words that exceed all three thresholds are personal data too, at each of their
places in any document, also far from the entity or without it. Equal rows count once. All spans
count code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textrisk.llm.columns import numbered
from textrisk.operators.lookups import BROADCAST_ROWS
from textrisk.session import staged

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
PLACEHOLDERS = {kind: f"[{kind.upper()}]" for kind in (*KINDS, TERM)}

# Each pattern finds what the plain form in its comment finds. Runs are taken whole and are
# only tried at their beginning or where the last match ended, so that long runs cost no more
# than their length.
_PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([ -]?[0-9])+
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    # \+[0-9][ ().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Texts that can have a match; the first is cheap to test and spares the pattern most texts.
_HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_WORD = r"\p{L}[\p{L}\p{M}\p{N}]*+"
_PLACED = "array<struct<start:int,end:int,value:string>>"
_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


@dataclass(frozen=True)
class Disclosure:
    """Thresholds, and how many characters on each side of an entity are its surroundings."""

    support: int = 3
    share: float = 0.5
    bits: float = 6.0
    surroundings: int = 80


def _placed(text: Column, pattern: str) -> Column:
    """Matches of a pattern from left to right with their places."""
    pieces = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")),
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_PLACED).alias("out"))

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + piece["gap"]
        end = start + F.length(piece["match"])
        entry = F.struct(start.alias("start"), end.alias("end"), piece["match"].alias("value"))
        return F.when(
            piece["match"].isNotNull(),
            F.struct(end.alias("at"), F.concat(state["out"], F.array(entry)).alias("out")),
        ).otherwise(state)

    return F.aggregate(pieces, empty, step, lambda state: state["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, place, 1).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(place % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    count = F.length(_digits(value))
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "card":
        # Only a value of the right length is summed up.
        return F.when(count.between(16, 19), _luhn(value)).otherwise(F.lit(False))
    if kind == "phone":
        return count.between(8, 15)
    return F.lit(True)


def _of_kind(text: Column, kind: str) -> Column:
    placed = F.when(text.rlike(_HINTS[kind]), _placed(text, _PATTERNS[kind]))
    named = F.transform(
        F.filter(placed, lambda span: _valid(kind, span["value"])),
        lambda span: F.struct(F.lit(kind).alias("kind"), span["start"], span["end"], span["value"]),
    )
    return F.coalesce(named.cast(_SPANS), F.array().cast(_SPANS))


def entities(text: Column) -> Column:
    """Valid matches of all kinds, by kind, then place; null text has none."""
    return F.concat(*[_of_kind(text, kind) for kind in KINDS])


def _near(text: Column, span: Column, reach: int) -> Column:
    """Words wholly inside the surroundings of an entity, in lower case, with their places.

    One character more is looked at on each side, to tell words that the edge cuts."""
    first = F.greatest(span["start"] - reach - 1, F.lit(0))
    left = F.substring(text, first + 1, span["start"] - first)
    right = F.substring(text, span["end"] + 1, F.lit(reach + 1))
    from_start = first == 0
    to_end = span["end"] + reach + 1 >= F.length(text)
    before = F.filter(_placed(left, _WORD), lambda w: from_start | (w["start"] > 0))
    after = F.filter(_placed(right, _WORD), lambda w: to_end | (w["end"] <= reach))

    def moved(words: Column, by: Column) -> Column:
        return F.transform(
            words,
            lambda w: F.struct(
                F.lower(w["value"]).alias("word"), (w["start"] + by).alias("start"),
                (w["end"] + by).alias("end"),
            ),
        )

    return F.concat(moved(before, first), moved(after, span["end"]))


def _entity_rows(rows: DataFrame, reach: int) -> DataFrame:
    """Per entity of each row with ``row_key``, ``text``, ``base``: its name and words near it."""
    spans = rows.where(F.size("base") > 0).select("row_key", "text", F.explode("base").alias("span"))
    near = spans.select(
        "row_key",
        F.concat_ws(":", "span.kind", F.lower("span.value")).alias("entity"),
        _near(F.col("text"), F.col("span"), reach).alias("near"),
    )
    return near.withColumn("surroundings", F.xxhash64(F.col("near.word")))


def _sized(frame: DataFrame) -> DataFrame:
    """For a join: broadcast up to a counted size; beyond it both sides are shuffled."""
    small = frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(frame) if small else frame.hint("merge")


def _words(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``row_key`` and the different ``words`` of each row, in lower case; equal rows once.

    Only rows of the staged keys in ``repeated`` are moved."""
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))
    words = F.array_distinct(F.transform(found, F.lower)).alias("words")
    if repeated.isEmpty():
        return rows.select("row_key", words)
    marked = rows.join(_sized(repeated.withColumn("again", F.lit(True))), "row_key", "left")
    again = marked.where("again").select("row_key", words).dropDuplicates(["row_key"])
    return marked.where("again is null").select("row_key", words).unionByName(again)


def _revealing(near: DataFrame, words: DataFrame, total: int, limits: Disclosure) -> DataFrame:
    """Pairs of ``entity`` and ``word`` that exceed all thresholds; ``words`` are those of all
    ``total`` different rows."""
    met = near.select(
        "entity", "surroundings", "row_key", F.explode(F.array_distinct("near.word")).alias("word")
    )
    settings = near.select("entity", "surroundings").distinct().groupBy("entity").agg(
        F.count(F.lit(1)).alias("settings")
    )
    different = met.select("entity", "word", "surroundings").distinct()
    pairs = different.groupBy("entity", "word").agg(F.count(F.lit(1)).alias("support"))
    pairs = staged(pairs.where(F.col("support") >= limits.support))
    rows = met.select("entity", "word", "row_key").distinct().groupBy("entity", "word").agg(
        F.count(F.lit(1)).alias("rows")
    )
    # Documents with each word, over the whole corpus.
    spread = words.select(F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("documents")
    )
    measured = (
        pairs.join(rows, ["entity", "word"]).join(settings, "entity").join(spread, "word")
    )
    share = F.col("rows") / F.col("documents")
    lift = (F.col("support") / F.col("settings")) / (F.col("documents") / F.lit(float(max(total, 1))))
    return measured.where((share >= limits.share) & (F.log2(lift) >= limits.bits)).select(
        "entity", "word"
    )


def _row_key(documents: DataFrame) -> Column:
    return F.xxhash64(documents["doc_id"].cast("string"), documents["text"])


def _places(text: Column, words: Column) -> Column:
    """The places of ``words`` in a text, as spans; other words only move the place on."""
    pieces = F.zip_with(
        F.split(text, _WORD, -1),
        F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)),
        lambda gap, match: F.struct(
            F.length(gap).alias("gap"), F.length(match).alias("length"), F.lower(match).alias("word")
        ),
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + piece["gap"]
        end = start + piece["length"]
        entry = F.struct(
            F.lit(TERM).alias("kind"), start.alias("start"), end.alias("end"), piece["word"].alias("value")
        )
        out = F.when(
            F.array_contains(words, piece["word"]), F.concat(state["out"], F.array(entry))
        ).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    return F.aggregate(pieces, empty, step, lambda state: state["out"])


def _term_spans(rows: DataFrame, words: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per ``row_key`` the places of the revealing words, whichever entity they reveal."""
    chosen = staged(pairs.select("word").distinct())
    met = staged(
        words.select("row_key", F.explode("words").alias("word"))
        .join(_sized(chosen), "word")
        .groupBy("row_key")
        .agg(F.collect_set("word").alias("met"))
    )
    return (
        rows.join(_sized(met), "row_key")
        .select("row_key", _places(F.col("text"), F.col("met")).alias("terms"))
        .dropDuplicates(["row_key"])
    )


def find_personal_data(documents: DataFrame, limits: Disclosure = Disclosure()) -> DataFrame:
    """Per row ``doc_id``, ``row_key``, ``base`` (valid matches of the four kinds, by kind and
    place) and ``terms`` (revealing words by place; one may lie inside a match of ``base``).

    Null and empty texts have no spans. Repeated rows give repeated results and count once in
    the corpus. Rows without ``doc_id`` are treated like others. Further columns are ignored.
    """
    rows = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("row_key", _row_key(rows)).withColumn("base", entities(F.col("text")))
    found = staged(
        rows.select("doc_id", "row_key", "base", F.when(F.size("base") > 0, F.col("text")).alias("text"))
    )
    near = staged(_entity_rows(found, limits.surroundings))
    keys = found.groupBy("row_key").agg(F.count(F.lit(1)).alias("times"))
    total = keys.count()
    repeated = staged(keys.where("times > 1").select("row_key"))
    texts = rows.select("row_key", "text")
    words = _words(texts, repeated)
    terms = _term_spans(texts, words, _revealing(near, words, total, limits))
    none = F.array().cast(_SPANS)
    return found.drop("text").join(terms, "row_key", "left").withColumn(
        "terms", F.coalesce(F.col("terms").cast(_SPANS), none)
    )


def sanitise(documents: DataFrame, limits: Disclosure = Disclosure()) -> DataFrame:
    """``documents`` with every span in ``text`` replaced by the placeholder of its kind, and
    ``n_chars``, if there is such a column, counted anew. Overlapping spans become one
    placeholder, of the kind that begins first. A null text stays null."""
    own, place = numbered(documents)
    doc_id, text = place("doc_id"), place("text")
    marked = own.withColumn("plain", F.coalesce(F.col(text).cast("string"), F.lit("")))
    source = marked.select(F.col(doc_id).alias("doc_id"), F.col("plain").alias("text"))
    found = find_personal_data(source, limits)
    spans = (
        found.where((F.size("base") > 0) | (F.size("terms") > 0))
        .select("row_key", F.concat("base", "terms").alias("spans"))
        .dropDuplicates(["row_key"])
    )
    key = F.xxhash64(F.col(doc_id).cast("string"), F.col("plain"))
    # The spans grow with the documents, so neither side is broadcast at any size.
    joined = marked.withColumn("row_key", key).hint("merge").join(spans, "row_key", "left")
    cleaned = F.when(F.col("spans").isNull(), F.col(text)).otherwise(
        _replaced(F.col("plain"), F.col("spans"))
    )
    out = joined.withColumn(text, cleaned)
    if "n_chars" in (name.lower() for name in documents.columns):
        chars = place("n_chars")
        counted = F.when(F.col("spans").isNull(), F.col(chars)).otherwise(F.length(text))
        out = out.withColumn(chars, counted.cast(own.schema[chars].dataType))
    return out.select(*own.columns).toDF(*documents.columns)


def _replaced(text: Column, spans: Column) -> Column:
    placed = F.sort_array(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")
            ),
        )
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        mark = F.lit(None).cast("string")
        for kind, placeholder in PLACEHOLDERS.items():
            mark = F.when(span["kind"] == kind, F.lit(placeholder)).otherwise(mark)
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(span["start"] >= state["at"], F.concat(state["out"], gap, mark))
            .otherwise(state["out"]).alias("out"),
        )

    return F.aggregate(
        placed, start, step,
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))),
    )


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
