"""Patterns, word lists, weights and formats the results depend on.

Character classes are spelled out instead of using ``\\w`` and friends, because the
short forms of Java do not cover the Unicode ranges that text in the wild needs.
"""

# --- fixed values: character classes (used inside [...]) -----------------------
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
DIGIT = r"\p{Nd}"
# A position between a word character and anything else, in either direction.
WORD_EDGE = rf"(?:(?<![{WORD}])(?=[{WORD}])|(?<=[{WORD}])(?![{WORD}]))"

# --- fixed values: personal data and what replaces it ---------------------------
URL_PATTERN = rf"(?iu)https?://[^{SPACE}]+|www\.[^{SPACE}]+"
# An address starts at the first word character of a run of name characters, or right after
# the previous address. Starting nowhere else keeps long runs without an @ linear.
EMAIL_START = rf"(?:(?<![{WORD}.+-])([.+-]*+)(?=[{WORD}])|\G(?<=[{WORD}])(?=[.+-]))"
EMAIL_PATTERN = rf"{EMAIL_START}[{WORD}.+-]++@[{WORD}-]++\.[{WORD}.-]+{WORD_EDGE}"
PHONE_PATTERN = rf"(?<!{DIGIT})\+?{DIGIT}[{DIGIT}{SPACE}().-]{{7,}}{DIGIT}(?!{DIGIT})"
MENTION_PATTERN = rf"(?<![{WORD}])@[{WORD}]{{3,}}"
URL_MASK = "<URL>"
EMAIL_MASK = "$1<EMAIL>"  # $1: signs before the address
PHONE_MASK = "<PHONE>"
MENTION_MASK = "<MENTION>"

# --- fixed values: default word lists -------------------------------------------
PROFANITY_STEMS = (
    "бля", "сука", "хуй", "хуя", "хуе", "пизд", "еба", "еби",
    "ебл", "ёба", "ёби", "ёб", "муд", "долбо", "гандон",
)
HOSTILE_STEMS = ("идиот", "туп", "дебил", "урод", "ненавиж", "сдох")
HOSTILE_WORDS = ("заткнись", "убью")

# --- fixed values: risk score ------------------------------------------------------
PROFANITY_WEIGHT = 3.0
HOSTILE_WEIGHT = 2.0
EXCLAMATION_WEIGHT = 0.4
QUESTION_WEIGHT = 0.2
MARKS_COUNTED = 5
CAPS_WEIGHT = 3.0
CAPS_CEILING = 2.0
SHOUTED_WORD_WEIGHT = 0.8
SHOUTED_LETTER = "[А-ЯA-ZЁ]"
SHOUTED_WORD = SHOUTED_LETTER + "{4,}"

# --- fixed values: columns, names and texts ------------------------------------------
FEATURES = (
    "char_len", "word_count", "profanity_count", "hostile_count",
    "exclamation_count", "question_count", "caps_ratio",
)
BOOSTED_FEATURES = ("risk_score",) + FEATURES
SAMPLE_COLUMNS = (
    "label_id", "message_hash", "date", "hour", "month", "chat", "user", "text",
    "toxic", "notes", "selection_reason", "risk_score", "char_len", "word_count",
    "profanity_count", "hostile_count", "exclamation_count", "question_count",
    "caps_ratio",
)
SCORE_COLUMN_NAMES = (
    "toxic_score", "toxicity_score", "toxic score", "toxicity score",
    "score_toxicity", "score", "токсичность",
)
UNKNOWN_USER = "unknown"
PSEUDONYM_FORMAT = "user_%03d"
RISKY_REASON = "risk_candidate"
RANDOM_REASON = "random"
EVENING_HOURS = (18, 23)
EVENING_NAME = "evening_18_23"
OTHER_TIME_NAME = "other_time"
WEAK_QUANTILE = 0.8
MANUAL_SOURCE = "manual_binary"
WEAK_SOURCE_FORMAT = "auto_rules: bad_words or risk_score >= %.3f"
BAD_WORD_NOTE = "auto: bad word / hostile word"
HIGH_RISK_NOTE_FORMAT = "auto: risk_score >= %.3f"
# Score scale (largest value it may hold) and the cut used for it; above all: the last cut.
SCORE_CUTS = ((1.0, 0.5), (10.0, 5.0))
SCORE_CUT_ABOVE = 50.0
SUMMARY_METRICS = (
    "messages_used_in_notebook", "messages_after_filtering_full", "anonymous_users",
    "date_min", "date_max", "chats",
)
DEFAULT_SAMPLE_SIZE = 10_000
DEFAULT_SEED = 42
