"""Counting listed words behind the cheap search for any of them."""

import pytest
from pyspark.sql import functions as F

from textrisk.functions import fixed, risk, text

TEXTS = [
    None, "", "a quiet text", "IDIOT idiots, anidiot", "İdiot and ıdiot", "ſtupid ſTUPID", "Knot KNOT",
    "i̇diot", "Ты ТУПОЙ, тупой", "ЁБ ёба", "ᲂб ебл", "straße STUPIDÉ", "loser" * 3, "x loser",
]


@pytest.mark.parametrize(
    "stems, words",
    [(("idiot", "stupid", "KNOT"), ()), (fixed.HOSTILE_STEMS, fixed.HOSTILE_WORDS), (fixed.PROFANITY_STEMS, ()),
     (("straße", "lo-"), ("x",)), ((), ("loser", "Idiots")), ((), ())],
)
def test_same_counts_as_the_pattern(spark, stems, words):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    expected = risk.count_matches("text", risk.lexicon_pattern(stems, words))
    rows = frame.select("text", expected.alias("a"), risk.count_listed("text", stems, words).alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]


def test_every_letter_the_pattern_takes_for_a_plain_one_folds_to_it(spark):
    plain = "abcdefghijklmnopqrstuvwxyzабвгдежзийклмнопрстуфхцчшщъыьэюяё"
    codes = [i for i in range(1, 0x20000) if not 0xD800 <= i < 0xE000]
    every = spark.createDataFrame([(chr(i),) for i in codes], "c string")
    taken = every.where(F.col("c").rlike(f"(?iu)^(?:{'|'.join(plain)})$")).select("c", risk.fold_case("c").alias("f"))
    found = taken.collect()
    assert len(found) > 2 * len(plain) and all(r.f in plain.upper() for r in found)


def test_plain_words_are_looked_for_before_the_pattern(spark):
    frame = spark.createDataFrame([("a",)], "text string")
    plan = risk.add_features(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("contains(") >= len(fixed.HOSTILE_STEMS)


def test_capitals_and_white_space_as_before(spark):
    word, space = fixed.WORD, fixed.SPACE
    odd = ["ABCD", "xABCD ABCDx", "ABCDE!FGHI ЁЖИК", "ÉABCD", " a  b  c\t", "ab \u0085", "!  ~", "ǅ Àb Ⅰx", ""]
    frame = spark.createDataFrame([(t,) for t in odd], "text string")
    letters = F.regexp_replace("text", r"\P{L}+", "")
    before = [
        F.regexp_count("text", F.lit(rf"(?<![{word}])[А-ЯA-ZЁ]{{4,}}(?![{word}])")),
        F.trim(F.regexp_replace("text", rf"[{space}&&[^ ]][{space}]*| [{space}]+", " ")),
        F.coalesce(F.try_divide(F.length(F.regexp_replace(letters, r"\P{Lu}+", "")), F.length(letters)), F.lit(0.0)),
    ]
    after = [risk.shouted_words("text"), text.collapse_space("text"), risk.caps_ratio("text")]
    for a, b in zip(before, after):
        assert frame.select(a).collect() == frame.select(b).collect()
