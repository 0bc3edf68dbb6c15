"""Text and date columns against Python's own ``re``, ``hashlib`` and ``datetime``."""

import hashlib
import random
import re
from datetime import datetime

from pyspark.sql import functions as F

from textrisk.functions import dates, risk, text
from textrisk.functions.risk import Lexicon

ALPHABET = (
    list("aбЁZЖ9٣_") + list(" \t\n  \x1c\x85") + list("@.+-()/:!?<>,;'\"")
    + ["http://", "www.", "@name", "x@y.zz", "+7 900 123-45-67", "идиот", "Туп", "убью", "ёлка",
       "АБВГ", "ǅ", "Ⅷ", "①", "ı", "K", "é", "‿"]
)


def random_texts(count, seed):
    source = random.Random(seed)
    return ["".join(source.choices(ALPHABET, k=source.randint(0, 40))) for _ in range(count)]


def column(spark, texts, *expressions):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(8)
    rows = frame.select("i", *expressions).orderBy("i").collect()
    return [tuple(row)[1:] for row in rows]


def masked_by_re(value):
    steps = [  # fixed values: the masks as Python's re spells them
        (r"(?i)https?://\S+|www\.\S+", "<URL>"),
        (r"\b[\w.+-]+@[\w-]+\.[\w.-]+\b", "<EMAIL>"),
        (r"(?<!\d)\+?\d[\d\s().-]{7,}\d(?!\d)", "<PHONE>"),
        (r"(?<!\w)@\w{3,}", "<MENTION>"),
    ]
    for pattern, mask in steps:
        value = re.sub(pattern, mask, value)
    return value


def test_anonymize_equals_python(spark):
    texts = random_texts(6000, 1)
    got = column(spark, texts, text.anonymize("text"))
    expected = [re.sub(r"\s+", " ", masked_by_re(t)).strip() for t in texts]
    assert [g[0] for g in got] == expected


def test_has_text_is_what_anonymize_leaves(spark):
    texts = random_texts(3000, 2) + ["", " ", "\t ", "\x1c \x85"]
    got = column(spark, texts, text.has_text("text"), text.anonymize("text"))
    assert all(visible == (cleaned != "") for visible, cleaned in got)


def test_features_equal_python(spark):
    lexicon = Lexicon(("туп", "a"), ("убью",), ("идиот",), ("ёлка", "name"))
    texts = random_texts(4000, 3)
    columns = risk.feature_columns("text", lexicon)
    columns["shouted"] = risk.shouted_words("text")
    got = column(spark, texts, *[c.alias(n) for n, c in columns.items()])
    for value, row in zip(texts, got):
        letters = [c for c in value if c.isalpha()]
        share = sum(c.isupper() for c in letters) / len(letters) if letters else 0.0
        assert row == (
            len(value),
            len(re.findall(r"\w+", value)),
            len(re.findall(r"(?i)\b(?:туп\w*|a\w*|убью\b)", value)),
            len(re.findall(r"(?i)\b(?:идиот\w*|ёлка\b|name\b)", value)),
            value.count("!"),
            value.count("?"),
            share,
            len(re.findall(r"\b[А-ЯA-ZЁ]{4,}\b", value)),
        ), value


def test_default_lexicon_and_risk(spark):
    frame = spark.createDataFrame(
        [("Ты ИДИОТ! сука, убью. Заткнись??",), ("убьют сукам",), ("ПРИВЕТ ВСЕМ!!!!!!!!!",)], "text string"
    )
    rows = risk.add_features(frame, count_shouted=True).collect()
    assert [(r.profanity_count, r.hostile_count) for r in rows] == [(1, 3), (1, 0), (0, 0)]
    plain = risk.add_features(frame).collect()
    assert abs(plain[2].risk_score - (5 * 0.4 + 2.0)) < 1e-12
    assert abs(rows[2].risk_score - (5 * 0.4 + 2.0 + 2 * 0.8)) < 1e-12


def test_short_hash(spark):
    frame = spark.createDataFrame([("a.json", 7, "u", "t"), ("a.json", None, "u", "ё")], "f string, i int, u string, t string")
    got = [r[0] for r in frame.select(text.short_hash("f", "i", "u", "t")).collect()]
    assert got == [hashlib.sha256(p.encode()).hexdigest()[:16] for p in ("a.json|7|u|t", "a.json|None|u|ё")]


def test_parse_iso(spark):
    good = [
        "2024-01-02T03:04:05", "2024-01-02 03:04:05", "2024-01-02", "20240102", "2024-01-02T03",
        "2024-01-02T03:04", "2024-01-02T03:04:05.123456", "2024-01-02T03:04:05,5",
        "2024-01-02T03:04:05+03:00", "2024-01-02T03:04:05Z", "20240102T030405", "2024-02-29",
    ]
    bad = ["", "bad", "2024", "2024-1-2", "2024-13-01", "2023-02-29", "2024-01-02T25:00:00", None,
           "2024-01-02T", "2024-01-02T3:04:05", "2024-01-02T03:04:05+3"]
    got = [r[0] for r in column(spark, good + bad, dates.parse_iso("text"))]
    expected = [datetime.fromisoformat(g).replace(tzinfo=None) for g in good]
    assert got == expected + [None] * len(bad)


def test_flatten_rich_text(spark):
    cases = {
        '"abc"': "abc",
        '["a",{"type":"bold","text":"b"},"c"]': "abc",
        '["a",{"type":"x"},5]': "a",
        '"[\\"abc\\"]"': '["abc"]',
        "5": "", "null": "", '{"text":"x"}': "", "[]": "", '["",["n"],null]': "",
    }
    frame = spark.createDataFrame(list(enumerate(cases)), "i int, j string")
    value = F.parse_json("j")
    got = frame.select("i", text.flatten_rich_text(value)).orderBy("i").collect()
    assert [r[1] for r in got] == list(cases.values())


def test_tokens_and_ngrams(spark):
    got = column(spark, ["One two, x Three_4 five", "a b", ""], text.tokens("text"),
                 text.ngrams(text.tokens("text"), 2), text.ngrams(text.tokens("text"), 3))
    assert got[0] == (["one", "two", "three_4", "five"], ["one two", "two three_4", "three_4 five"],
                      ["one two three_4", "two three_4 five"])
    assert got[1] == ([], [], []) and got[2] == ([], [], [])


def test_to_number(spark):
    got = column(spark, ["1.5", " 2 ", "x", "", "NaN"], risk.to_number("text"), risk.to_number("text", None))
    assert got == [(1.5, 1.5), (2.0, 2.0), (0.0, None), (0.0, None), (0.0, None)]
