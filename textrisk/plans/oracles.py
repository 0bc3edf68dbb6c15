"""The same results in DuckDB's SQL, written against the given tables.

DuckDB's regular expressions have no lookaround, so masks and word matches are worded
differently here than in the library.
"""

from __future__ import annotations

from textrisk.functions import fixed
from textrisk.operators.meancut import draw_cuts
from textrisk.operators.models import draw_settings
from textrisk.plans.catalog import CLOSED_MODELS
from textrisk.plans.inputs import TABLE_LEXICON
from textrisk.plans.training import SIZES, TRIALS

ORACLES: dict[str, str] = {}

_W = r"\p{L}\p{N}_"
_S = r"\s\x0b\x1c-\x1f\x85\p{Z}"
_D = r"\p{Nd}"


def _clean(column: str) -> str:
    urls = rf"regexp_replace({column}, '(?i)https?://[^{_S}]+|www\.[^{_S}]+', '<URL>', 'g')"
    emails = rf"regexp_replace({urls}, '[{_W}][{_W}.+-]*@[{_W}-]+\.[{_W}.-]*[{_W}]', '<EMAIL>', 'g')"
    return _space(_mentions(_phones(emails)))


def _phones(column: str) -> str:
    guarded = rf"regexp_replace({column}, '({_D})\+({_D})', '\1+' || chr(1) || '\2', 'g')"
    masked = rf"regexp_replace({guarded}, '\+?{_D}[{_D}{_S}().-]{{7,}}{_D}', '<PHONE>', 'g')"
    return f"replace({masked}, chr(1), '')"


def _mentions(column: str) -> str:
    return rf"regexp_replace({column}, '(^|[^{_W}])@[{_W}]{{3,}}', '\1<MENTION>', 'g')"


def _space(column: str) -> str:
    return rf"trim(regexp_replace({column}, '[{_S}]+', ' ', 'g'), ' ')"


def _count(column: str, pattern: str) -> str:
    return f"len(regexp_extract_all({column}, '{pattern}'))"


def _words(column: str, entries) -> str:
    return _count(column, rf"(?i)(?:^|[^{_W}])(?:{'|'.join(entries)})[{_W}]*")


def _features(source: str, keys: str, column: str = "text") -> str:
    """Rows of ``source`` with the seven features, the all-caps words and the risk score."""
    return rf"""
    SELECT *,
      profanity_count * 3.0::DOUBLE + hostile_count * 2.0::DOUBLE
        + least(exclamation_count, 5) * 0.4::DOUBLE + least(question_count, 5) * 0.2::DOUBLE
        + least(caps_ratio * 3.0::DOUBLE, 2.0::DOUBLE) AS risk_score
    FROM (
      SELECT {keys},
        length({column})::INTEGER AS char_len,
        {_count(column, f'[{_W}]+')}::INTEGER AS word_count,
        {_words(column, TABLE_LEXICON.profanity_stems)}::INTEGER AS profanity_count,
        {_words(column, TABLE_LEXICON.hostile_stems)}::INTEGER AS hostile_count,
        (length({column}) - length(replace({column}, '!', '')))::INTEGER AS exclamation_count,
        (length({column}) - length(replace({column}, '?', '')))::INTEGER AS question_count,
        CASE WHEN length(regexp_replace({column}, '\P{{L}}', '', 'g')) > 0
          THEN length(regexp_replace({column}, '\P{{Lu}}', '', 'g'))::DOUBLE
            / length(regexp_replace({column}, '\P{{L}}', '', 'g')) ELSE 0.0::DOUBLE END AS caps_ratio,
        len(list_filter(regexp_extract_all({column}, '[{_W}]+'),
          lambda w: regexp_full_match(w, '{fixed.SHOUTED_WORD}')))::INTEGER AS all_caps_words
      FROM {source})"""


_CLEAN = rf"""clean AS (
  SELECT doc_id, source, {_clean('text')} AS text FROM documents
  WHERE regexp_matches(text, '[^{_S}]'))"""
_FEATURED = f"{_CLEAN}, featured AS ({_features('clean', 'doc_id, source, text')})"

_EVENTS = """timed AS (
  SELECT event_id AS doc_id,
    CASE WHEN event_type = 'signup' THEN 'service' ELSE 'message' END AS type,
    CASE WHEN event_id % 31 <> 0 THEN 'user' || user_id ELSE 'unknown' END AS raw_user_id,
    CASE WHEN event_id % 29 <> 0 THEN ts + to_days(CAST(
      CASE WHEN (event_id * 37) % 700 BETWEEN 100 AND 200 THEN (event_id * 37) % 700 + 600
        ELSE (event_id * 37) % 700 END AS INTEGER)) END AS date
  FROM events)"""
_RISK = f"""{_FEATURED}, {_EVENTS}, scored AS (
  SELECT f.doc_id, f.source AS chat, f.risk_score, f.profanity_count, f.hostile_count,
    t.date, hour(t.date)::INTEGER AS hour, t.raw_user_id
  FROM featured f JOIN timed t USING (doc_id) WHERE t.type = 'message')"""
_NAMES = """named AS (
  SELECT raw_user_id, printf('user_%03d', row_number() OVER (ORDER BY raw_user_id)) AS user
  FROM (SELECT DISTINCT raw_user_id FROM scored))"""
_WEAK = f"""threshold AS (SELECT quantile_cont(risk_score, {fixed.WEAK_QUANTILE}) AS cut FROM scored),
weak AS (
  SELECT s.*, (profanity_count > 0 OR hostile_count > 0) AS bad,
    round(risk_score, 9) >= round(cut, 9) AS high, cut FROM scored s, threshold)"""
_RATED = f"""{_FEATURED}, rated AS (
  SELECT f.doc_id, l.toxic AS label, f.risk_score AS score,
    (f.risk_score >= 2.0)::INTEGER AS prediction
  FROM featured f JOIN labels l USING (doc_id))"""
_CELLS = f"""{_RATED}, cells AS (
  SELECT count(*) FILTER (label <> 1 AND prediction <> 1)::DOUBLE AS tn,
    count(*) FILTER (label <> 1 AND prediction = 1)::DOUBLE AS fp,
    count(*) FILTER (label = 1 AND prediction <> 1)::DOUBLE AS fn,
    count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE AS tp FROM rated)"""
_POINTS = f"""{_RATED}, per_score AS (
  SELECT score AS threshold, sum(label) AS pos, sum(1 - label) AS neg FROM rated GROUP BY 1),
points AS (
  SELECT threshold, pos, neg,
    sum(pos) OVER (ORDER BY threshold DESC)::DOUBLE AS tp,
    sum(neg) OVER (ORDER BY threshold DESC)::DOUBLE AS fp,
    sum(pos) OVER ()::DOUBLE AS all_pos, sum(neg) OVER ()::DOUBLE AS all_neg
  FROM per_score)"""


def _key(*parts: str) -> str:
    return f"substring(md5(concat_ws('|', {', '.join(parts)})), 1, 15)"


def _ngram_counts(high: int) -> str:
    """Rows doc_id, term, words, tf."""
    def joined(n: int) -> str:
        return " || ' ' || ".join(f"words[i + {k}]" if k else "words[i]" for k in range(n))

    parts = [
        f"""SELECT doc_id, unnest(list_transform(range(1, greatest(len(words) - {n} + 2, 1)),
              lambda i: {joined(n)})) AS term, {n} AS size FROM worded"""
        for n in range(1, high + 1)
    ]
    return rf"""{_CLEAN}, worded AS (
      SELECT doc_id, regexp_extract_all(lower(text), '[{_W}]{{2,}}') AS words FROM clean),
    counts AS (
      SELECT doc_id, term, size, count(*) AS tf FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL)"""


def _vocabulary(high: int, limit: int, max_df: float = 1.0) -> str:
    return f"""{_ngram_counts(high)}, total AS (SELECT count(*) AS n FROM clean),
    terms AS (
      SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf,
        ln((1.0::DOUBLE + any_value(n)) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf
      FROM counts, total GROUP BY term
      HAVING count(*) >= 2 AND count(*) <= any_value(n) * {max_df}::DOUBLE
      ORDER BY cf DESC, term LIMIT {limit})"""


def _weights(sublinear: bool, max_df: float = 1.0) -> str:
    tf = "ln(tf::DOUBLE) + 1.0::DOUBLE" if sublinear else "tf::DOUBLE"
    return f"""WITH {_vocabulary(2, 5000, max_df)}, raw AS (
      SELECT doc_id, term, ({tf}) * idf AS raw FROM counts JOIN terms USING (term))
    SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight
    FROM raw"""


def _sample(size: int, floor: float) -> str:
    return f"""{_FEATURED}, rows_ AS (
      SELECT substring(sha256(concat_ws('|', source, doc_id, text)), 1, 16) AS message_hash,
        risk_score FROM featured), {_draw(size, floor)}"""


def _draw(size: int, floor: float) -> str:
    """From ``rows_`` with ``message_hash`` and ``risk_score`` to ``sample``."""
    quota = size // 2
    return f"""risky AS (
      SELECT * FROM rows_ WHERE risk_score > {floor}
      ORDER BY {_key("'42:risky'", 'message_hash')} LIMIT {quota}),
    rest AS (
      SELECT * FROM rows_ WHERE message_hash NOT IN (SELECT message_hash FROM risky)
      ORDER BY {_key("'42:random'", 'message_hash')} LIMIT {size} - (SELECT count(*) FROM risky)),
    drawn AS (
      SELECT *, 'risk_candidate' AS selection_reason FROM risky
      UNION ALL SELECT *, 'random' FROM rest),
    sample AS (
      SELECT row_number() OVER (ORDER BY {_key("'42:shuffle'", 'message_hash', 'selection_reason')})
        AS label_id, * FROM drawn)"""


def _class_rank(purpose: str, wanted: str = "0") -> str:
    """``quota``: ``wanted`` rows (over the row count ``total``) dealt by largest remainder."""
    return f"""sizes AS (
      SELECT toxic, n, total, ({wanted})::BIGINT AS wanted
      FROM (SELECT toxic, count(*) AS n, (SELECT count(*) FROM labels) AS total FROM labels GROUP BY toxic)),
    quotas AS (
      SELECT toxic, wanted * n // total + (row_number() OVER (ORDER BY wanted * n % total DESC, toxic)
        <= wanted - sum(wanted * n // total) OVER ())::BIGINT AS quota FROM sizes),
    ordered AS (
      SELECT doc_id, toxic,
        row_number() OVER (PARTITION BY toxic ORDER BY {_key(f"'42:{purpose}'", 'doc_id')}) AS rank,
        ntile(5) OVER (PARTITION BY toxic ORDER BY {_key(f"'42:{purpose}'", 'doc_id')}) AS piece,
        count(*) OVER (PARTITION BY toxic) AS n, count(*) OVER () AS total
      FROM labels),
    ranked AS (SELECT * FROM ordered JOIN quotas USING (toxic))"""


_SCORES = f"""{_FEATURED}, marked AS (
  SELECT f.doc_id, CASE WHEN l.quality = 1 THEN least(caps_ratio * 2, 1.0::DOUBLE) * %s END AS score
  FROM featured f JOIN labels l USING (doc_id)),
cut AS (SELECT CASE WHEN max(score) <= 1 THEN 0.5 WHEN max(score) <= 10 THEN 5 ELSE 50 END::DOUBLE
  AS cut FROM marked)
SELECT doc_id, round(score, 6) AS toxicity_score_label, (score >= cut)::INTEGER AS toxic,
  'Toxic-Score >= ' || CASE WHEN cut = 0.5 THEN '0.5' ELSE cut::INTEGER::VARCHAR END AS label_source
FROM marked, cut WHERE score IS NOT NULL"""

_MARKED = """marked AS (
  SELECT d.doc_id, CASE WHEN l.quality = 1 THEN l.toxic::VARCHAR WHEN l.toxic = 1 THEN '2'
    WHEN l.doc_id IS NOT NULL THEN 'x' END AS mark
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

# --- text -------------------------------------------------------------------------------

ORACLES["anonymize_text"] = f"WITH {_CLEAN} SELECT doc_id, text FROM clean"
ORACLES["anonymize_pages"] = f"SELECT page_id, {_clean('html')} AS text FROM pages"
ORACLES["anonymize_conversations"] = (
    f"SELECT conv_id, turn, {_clean('text')} AS text FROM conversations"
)
ORACLES["mask_steps"] = rf"""SELECT page_id,
  length(regexp_replace(html, '(?i)https?://[^{_S}]+|www\.[^{_S}]+', '<URL>', 'g'))::INTEGER AS url_len,
  length(regexp_replace(html, '[{_W}][{_W}.+-]*@[{_W}-]+\.[{_W}.-]*[{_W}]', '<EMAIL>', 'g'))::INTEGER
    AS email_len,
  length({_phones('html')})::INTEGER AS phone_len,
  length({_mentions('html')})::INTEGER AS mention_len,
  length({_space('html')})::INTEGER AS space_len
FROM pages"""
ORACLES["message_view"] = f"""WITH {_CLEAN}, {_EVENTS}
SELECT substring(sha256(concat_ws('|', source || '.json', doc_id, raw_user_id, text)), 1, 16)
    AS message_hash,
  date, hour(date)::INTEGER AS hour, strftime(date, '%Y-%m') AS month, source AS chat,
  raw_user_id, text
FROM clean JOIN timed USING (doc_id) WHERE type = 'message'"""
_COUNTERS = rf"""{_EVENTS}, counters AS (
  SELECT source || '.json' AS file, count(*) AS raw_messages,
    count(*) FILTER (type = 'message' AND regexp_matches(text, '[^{_S}]')) AS kept_messages,
    count(*) FILTER (type <> 'message') AS service_or_non_message,
    count(*) FILTER (type = 'message' AND NOT regexp_matches(text, '[^{_S}]')) AS empty_text
  FROM documents JOIN timed USING (doc_id) GROUP BY 1)"""
ORACLES["file_counters"] = f"WITH {_COUNTERS} SELECT * FROM counters"
ORACLES["summary_totals"] = f"""WITH {_COUNTERS}
SELECT sum(raw_messages)::BIGINT AS total_raw_messages,
  sum(kept_messages)::BIGINT AS total_kept_messages FROM counters"""
ORACLES["pseudonyms"] = f"""WITH {_RISK}, {_NAMES}
SELECT raw_user_id, user, count(*) AS user_rows FROM scored JOIN named USING (raw_user_id) GROUP BY ALL"""
ORACLES["pseudonymized_messages"] = f"""WITH {_CLEAN}, {_EVENTS}, scored AS (
  SELECT substring(sha256(concat_ws('|', source || '.json', doc_id, raw_user_id, text)), 1, 16)
    AS message_hash, source AS chat, raw_user_id
  FROM clean JOIN timed USING (doc_id) WHERE type = 'message'), {_NAMES}
SELECT message_hash, chat, user FROM scored JOIN named USING (raw_user_id)"""
ORACLES["conversation_counters"] = rf"""SELECT role AS file, count(*) AS raw_messages,
  count(*) FILTER (role <> 'system' AND regexp_matches(text, '[^{_S}]')) AS kept_messages,
  count(*) FILTER (role = 'system') AS service_or_non_message,
  count(*) FILTER (role <> 'system' AND NOT regexp_matches(text, '[^{_S}]')) AS empty_text
FROM conversations GROUP BY role"""
ORACLES["all_texts"] = rf"""SELECT source, count(*) AS messages, sum(length({_clean('text')}))::BIGINT AS chars
FROM (SELECT 'documents' AS source, text FROM documents
  UNION ALL SELECT 'conversations', text FROM conversations)
WHERE regexp_matches(text, '[^{_S}]') GROUP BY source"""

ORACLES["rich_text"] = """SELECT conv_id, turn,
  CASE WHEN role = 'system' THEN text ELSE text || text END AS text FROM conversations"""
ORACLES["message_lines"] = f"""WITH {_CLEAN}, {_EVENTS}
SELECT date, hour(date)::INTEGER AS hour, strftime(date, '%Y-%m') AS month, raw_user_id, text
FROM clean JOIN timed USING (doc_id) WHERE type = 'message'"""
ORACLES["chat_list"] = f"""WITH {_CLEAN}, {_EVENTS}
SELECT source AS chat, count(*) AS messages FROM clean JOIN timed USING (doc_id)
WHERE type = 'message' GROUP BY source"""

# --- dates ---------------------------------------------------------------------------------

ORACLES["date_parts"] = """SELECT event_id, ts AS date, hour(ts)::INTEGER AS hour,
  strftime(ts, '%Y-%m') AS month, last_day(ts) AS month_end,
  CASE WHEN hour(ts) BETWEEN 18 AND 23 THEN 'evening_18_23' ELSE 'other_time' END AS day_part
FROM events"""

# --- features --------------------------------------------------------------------------------

_SEVEN = """char_len, word_count, profanity_count, hostile_count, exclamation_count, question_count,
  round(caps_ratio, 6) AS caps_ratio"""
ORACLES["message_features"] = f"WITH {_FEATURED} SELECT doc_id, {_SEVEN} FROM featured"
ORACLES["conversation_features"] = f"""SELECT conv_id, turn, {_SEVEN}, round(risk_score, 6) AS risk_score
FROM ({_features('conversations', 'conv_id, turn')})"""
ORACLES["risk_score"] = (
    f"WITH {_FEATURED} SELECT doc_id, round(risk_score, 6) AS risk_score FROM featured"
)
ORACLES["risk_score_caps"] = f"""WITH {_FEATURED}
SELECT doc_id, all_caps_words, round(risk_score + all_caps_words * 0.8::DOUBLE, 6) AS risk_score
FROM featured"""
ORACLES["sink_rounding"] = f"""WITH {_FEATURED}
SELECT doc_id, round_even(caps_ratio, 4) AS caps_ratio, round_even(risk_score, 4) AS risk_score
FROM featured"""
ORACLES["risk_candidates"] = f"""WITH {_FEATURED}
SELECT doc_id, round(risk_score, 6) AS risk_score FROM featured WHERE risk_score > 0"""
ORACLES["numeric_coercion"] = r"""SELECT event_id, coalesce(try_cast(
  CASE WHEN event_type = 'view' THEN regexp_extract(props, '(\d+)', 1) ELSE event_type END
  AS DOUBLE), 0.0::DOUBLE) AS number FROM events"""

# --- summaries ---------------------------------------------------------------------------------

ORACLES["dataset_summary"] = f"""WITH {_RISK}, wide AS (
  SELECT count(*)::VARCHAR AS n, count(DISTINCT raw_user_id)::VARCHAR AS users,
    strftime(min(date), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(date), '%Y-%m-%d %H:%M:%S') AS last,
    count(DISTINCT chat)::VARCHAR AS chats FROM scored)
SELECT 'messages_used_in_notebook' AS metric, n AS value FROM wide
UNION ALL SELECT 'messages_after_filtering_full', n FROM wide
UNION ALL SELECT 'anonymous_users', users FROM wide
UNION ALL SELECT 'date_min', first FROM wide
UNION ALL SELECT 'date_max', last FROM wide
UNION ALL SELECT 'chats', chats FROM wide"""
ORACLES["feature_describe"] = f"""WITH {_FEATURED}, tall AS (
  UNPIVOT (SELECT {', '.join(f'{f}::DOUBLE AS {f}' for f in fixed.FEATURES)} FROM featured)
  ON {', '.join(fixed.FEATURES)} INTO NAME feature VALUE value)
SELECT feature, count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
  round(max(value), 6) AS max
FROM tall GROUP BY feature"""
ORACLES["class_balance"] = """SELECT toxic, count(*) AS count,
  round(count(*) / sum(count(*)) OVER (), 6) AS share FROM labels GROUP BY toxic"""
ORACLES["class_weights"] = """WITH c AS (SELECT toxic, count(*) AS count FROM labels GROUP BY toxic)
SELECT toxic, count,
  round(sum(count) OVER () / (count(*) OVER () * count), 6) AS balanced_weight,
  round(sum(count) FILTER (toxic = 0) OVER ()::DOUBLE / sum(count) FILTER (toxic = 1) OVER (), 6)
    AS pos_weight FROM c"""
ORACLES["value_quantiles"] = """SELECT event_type, probability,
  round(quantile_cont(value, [0.05, 0.25, 0.5, 0.8, 0.99])[i], 6) AS quantile, count(value) AS rows
FROM events, (SELECT unnest(range(1, 6)) AS i, unnest([0.05, 0.25, 0.5, 0.8, 0.99])::DOUBLE AS probability)
GROUP BY event_type, probability, i"""

# --- labels -------------------------------------------------------------------------------------

_WEAK_ALL = _WEAK.replace("scored", "featured")
ORACLES["weak_labels"] = f"""WITH {_FEATURED}, {_WEAK_ALL}
SELECT doc_id, (bad OR high)::INTEGER AS toxic,
  printf('auto_rules: bad_words or risk_score >= %.3f', cut) AS label_source FROM weak"""
ORACLES["weak_label_notes"] = f"""WITH {_FEATURED}, {_WEAK_ALL}
SELECT doc_id, CASE WHEN bad THEN 'auto: bad word / hostile word'
  WHEN high THEN printf('auto: risk_score >= %.3f', cut)
  WHEN question_count = 0 THEN 'seen in ' || source ELSE '' END AS notes FROM weak"""
ORACLES["manual_labels"] = f"""WITH {_MARKED}
SELECT doc_id, mark::INTEGER AS toxic, 'manual_binary' AS label_source
FROM marked WHERE mark IN ('0', '1')"""
ORACLES["resolved_labels"] = f"""WITH {_MARKED}
SELECT 'manual_binary' AS label_source, mark::INTEGER AS toxic, count(*) AS rows
FROM marked WHERE mark IN ('0', '1') GROUP BY mark"""
ORACLES["resolved_by_score"] = f"""WITH {_FEATURED}, given AS (
  SELECT doc_id, least(caps_ratio * 2, 1.0::DOUBLE) AS score FROM featured JOIN labels USING (doc_id)),
limits AS (SELECT CASE WHEN max(score) <= 1 THEN 0.5 ELSE 5 END::DOUBLE AS cut FROM given)
SELECT doc_id, (score >= cut)::INTEGER AS toxic, 'Toxic-Score >= 0.5' AS label_source FROM given, limits"""
ORACLES["resolved_by_rules"] = ORACLES["weak_labels"]
ORACLES["training_rows"] = f"""WITH {_FEATURED}
SELECT doc_id, l.toxic::INTEGER AS toxic, 'manual_binary' AS label_source,
  CASE WHEN doc_id % 7 <> 0 THEN char_len END::DOUBLE AS char_len
FROM featured JOIN labels l USING (doc_id) WHERE doc_id % 5 <> 0"""
ORACLES["planted_violations"] = """SELECT count(*) AS rows, count(*) FILTER (doc_id % 4 = 0) AS empty_text,
  count(*) FILTER (doc_id % 6 = 0 OR doc_id % 9 = 0) AS bad_pseudonym, 1::BIGINT AS raw_id_columns,
  any_value(labels) AS labels, any_value(bad_label) AS bad_label
FROM documents, (SELECT count(*) AS labels, count(*) FILTER (doc_id % 3 = 0 OR doc_id % 5 = 0) AS bad_label FROM labels)"""
ORACLES["score_labels"] = "WITH " + _SCORES % "100.0::DOUBLE"
ORACLES["score_labels_unit"] = "WITH " + _SCORES % "1.0::DOUBLE"
ORACLES["score_scale"] = """SELECT event_type, max(value) AS largest,
  CASE WHEN max(value) <= 1 THEN 0.5 WHEN max(value) <= 10 THEN 5 ELSE 50 END::DOUBLE AS cut
FROM events GROUP BY event_type"""

# --- draws ---------------------------------------------------------------------------------------

ORACLES["row_cap"] = f"""SELECT doc_id, source FROM documents
ORDER BY {_key("'42'", 'doc_id')} LIMIT 500"""
ORACLES["labeling_sample"] = f"""WITH {_sample(300, 1.0)}
SELECT label_id, message_hash, selection_reason, round(risk_score, 6) AS risk_score,
  NULL::VARCHAR AS toxic, NULL::VARCHAR AS notes FROM sample"""
ORACLES["labeling_sample_default"] = f"""WITH {_sample(250, 0.0)}
SELECT label_id, message_hash, selection_reason FROM sample"""
ORACLES["sample_file"] = f"""WITH {_CLEAN}, {_EVENTS},
scored AS (
  SELECT substring(sha256(concat_ws('|', source || '.json', doc_id, raw_user_id, text)), 1, 16)
    AS message_hash, date, hour(date)::INTEGER AS hour, strftime(date, '%Y-%m') AS month,
    source AS chat, raw_user_id, text
  FROM clean JOIN timed USING (doc_id) WHERE type = 'message'),
{_NAMES}, rows_ AS (
  SELECT f.*, user FROM ({_features('scored', '*')}) f JOIN named USING (raw_user_id)),
{_draw(200, 1.0)}
SELECT label_id, message_hash, date, hour, month, chat, user, text, NULL::VARCHAR AS toxic,
  NULL::VARCHAR AS notes, selection_reason, round(risk_score, 6) AS risk_score, char_len, word_count,
  profanity_count, hostile_count, exclamation_count, question_count, round(caps_ratio, 6) AS caps_ratio
FROM sample"""
ORACLES["unlabelled_documents"] = """SELECT source, count(*) AS documents FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY source"""
_FIFTH = "floor(0.2 * total + 0.5)"
ORACLES["holdout_split"] = f"""WITH {_class_rank('holdout', _FIFTH)}
SELECT doc_id, toxic, rank <= quota AS is_test FROM ranked"""
ORACLES["stratified_subsample"] = f"""WITH {_class_rank('subsample', 'least(150, total)')}
SELECT doc_id, toxic FROM ranked WHERE rank <= quota"""
ORACLES["kfold_assignment"] = f"""WITH {_class_rank('folds')}
SELECT doc_id, toxic, (piece - 1)::INTEGER AS fold FROM ranked"""
ORACLES["learning_prefixes"] = f"""WITH {_class_rank('prefix')}
SELECT doc_id, toxic, ({' + '.join(
    f"(rank > greatest(1, floor({f} * n + 0.5)))::INTEGER" for f in (0.2, 0.4, 0.6, 0.8, 1.0)
)} + 1)::INTEGER AS prefix FROM ranked"""

# --- text vectors ----------------------------------------------------------------------------------

ORACLES["tokens_ngrams"] = f"""WITH {_ngram_counts(3)}
SELECT doc_id, size::INTEGER AS words, sum(tf)::BIGINT AS terms, count(*) AS distinct_terms
FROM counts GROUP BY doc_id, size"""
ORACLES["vocabulary"] = f"""WITH {_vocabulary(2, 15000)}
SELECT term, df, cf, round(idf, 6) AS idf FROM terms"""
ORACLES["vocabulary_max_df"] = f"""WITH {_vocabulary(1, 5000, 0.2)}
SELECT term, df, cf, round(idf, 6) AS idf FROM terms"""
ORACLES["tfidf"] = _weights(False)
ORACLES["tfidf_sublinear"] = _weights(True, 0.95)
ORACLES["impute_scale"] = f"""WITH {_FEATURED}, given AS (
  SELECT f.doc_id, l.quality, CASE WHEN word_count > 30 THEN char_len END::DOUBLE AS a,
    CASE WHEN exclamation_count = 0 THEN caps_ratio END AS b
  FROM featured f JOIN labels l USING (doc_id)),
medians AS (SELECT quantile_cont(a, 0.5) AS ma, quantile_cont(b, 0.5) AS mb FROM given WHERE quality = 1),
filled AS (SELECT doc_id, quality, coalesce(a, ma) AS a, coalesce(b, mb) AS b FROM given, medians),
moments AS (
  SELECT avg(a) AS aa, stddev_pop(a) AS sa, avg(b) AS ab, stddev_pop(b) AS sb
  FROM filled WHERE quality = 1)
SELECT doc_id, round((a - aa) / sa, 6) AS char_len, round((b - ab) / sb, 6) AS caps_ratio
FROM filled, moments"""

ORACLES["feature_vectors"] = f"""WITH {_ngram_counts(2)},
featured AS ({_features('clean', 'doc_id', 'text')}), {_class_rank('holdout', _FIFTH)},
split AS (SELECT doc_id, rank <= quota AS is_test FROM ranked),
train AS (SELECT count(*) AS n FROM split WHERE NOT is_test),
terms AS (
  SELECT term, ln((1.0::DOUBLE + any_value(n)) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf
  FROM counts JOIN split USING (doc_id), train WHERE NOT is_test GROUP BY term
  HAVING count(*) >= 2 ORDER BY sum(tf) DESC, term LIMIT 15000),
raw AS (
  SELECT doc_id, term, tf * idf AS raw
  FROM counts JOIN terms USING (term) JOIN split USING (doc_id)),
tall AS (
  UNPIVOT (SELECT doc_id, is_test, {', '.join(f'{f}::DOUBLE AS {f}' for f in fixed.FEATURES)}
    FROM featured JOIN split USING (doc_id))
  ON {', '.join(fixed.FEATURES)} INTO NAME name VALUE value),
moments AS (
  SELECT name, avg(value) AS mean, stddev_pop(value) AS dev FROM tall WHERE NOT is_test GROUP BY name),
slots AS (
  SELECT doc_id, term AS name, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS value FROM raw
  UNION ALL
  SELECT doc_id, name, (value - mean) / CASE WHEN dev = 0 THEN 1 ELSE dev END
  FROM tall JOIN moments USING (name))
SELECT doc_id, name, round(value, 6) AS value FROM slots WHERE value <> 0"""

# --- models --------------------------------------------------------------------------------------------

_NUMBERS = ", ".join(fixed.BOOSTED_FEATURES)
_SPLIT = f"""{_FEATURED}, labelled AS (
  SELECT doc_id, toxic, {_NUMBERS} FROM featured JOIN labels USING (doc_id)),
class_rows AS (SELECT toxic, count(*) AS n, sum(count(*)) OVER ()::BIGINT AS total FROM labelled GROUP BY toxic),
held AS (
  SELECT toxic, w * n // total + (row_number() OVER (ORDER BY w * n % total DESC, toxic)
    <= w - sum(w * n // total) OVER ())::BIGINT AS quota
  FROM (SELECT *, floor(0.2 * total + 0.5)::BIGINT AS w FROM class_rows)),
split AS (
  SELECT labelled.*, row_number() OVER (PARTITION BY toxic ORDER BY {_key("'42:holdout'", 'doc_id')}) <= quota
    AS is_test FROM labelled JOIN held USING (toxic)),
train AS (SELECT * FROM split WHERE NOT is_test)"""
_LITERAL = "CASE number {} END::DOUBLE".format(
    " ".join(f"WHEN '{name}' THEN {name}" for name in fixed.BOOSTED_FEATURES)
)
_CUT_SCORE = """CASE WHEN high <> low THEN least(1.0::DOUBLE, greatest(0.0::DOUBLE, 0.5::DOUBLE
    + (value - (low + position * (high - low))) / (high - low) * 0.5::DOUBLE)) ELSE 0.5::DOUBLE END"""


def _folded(source: str) -> str:
    """``folded``: the rows of ``source``, which has ``part``, with their fold and prefix."""
    steps = " + ".join(f"(turn + 1 > greatest(1, floor({f} * n + 0.5)))::INTEGER" for f in (0.2, 0.4, 0.6, 0.8, 1.0))
    return f"""part_rows AS (SELECT part, toxic, count(*) AS n FROM {source} GROUP BY ALL),
    part_folds AS (SELECT part, greatest(2, least(5, min(n))) AS folds FROM part_rows GROUP BY part),
    placed AS (
      SELECT s.*, n, folds, n // folds AS small, n % folds AS extra,
        row_number() OVER (PARTITION BY part, toxic ORDER BY {_key("'42:prefix'", 'doc_id')}) - 1 AS turn,
        row_number() OVER (PARTITION BY part, toxic ORDER BY {_key("'42:folds'", 'doc_id')}) - 1 AS seat
      FROM {source} s JOIN part_rows USING (part, toxic) JOIN part_folds USING (part)),
    folded AS (
      SELECT *, CASE WHEN seat < extra * (small + 1) THEN seat // (small + 1)
          ELSE extra + (seat - extra * (small + 1)) // small END AS fold, {steps} + 1 AS prefix
      FROM placed)"""


def _study(trials: str) -> str:
    """``rated``: F1 and area of each trial, fold and side. ``trials`` has trial, part, step, number, position."""
    return f"""trials AS ({trials}),
    member AS (
      SELECT trial, k.fold AS held, m.toxic, position, m.fold <> k.fold AS teaches, {_LITERAL} AS value
      FROM folded m JOIN trials t USING (part) JOIN (SELECT DISTINCT part, fold FROM folded) k USING (part)
      WHERE m.fold = k.fold OR step IS NULL OR m.prefix <= step),
    means AS (
      SELECT trial, held, avg(value) FILTER (toxic = 0) AS low, avg(value) FILTER (toxic = 1) AS high
      FROM member WHERE teaches GROUP BY ALL),
    scored_fits AS (SELECT *, {_CUT_SCORE} AS score FROM member JOIN means USING (trial, held)),
    ordered_fits AS (
      SELECT *, rank() OVER (PARTITION BY trial, held, teaches ORDER BY score)
        + (count(*) OVER (PARTITION BY trial, held, teaches, score) - 1) / 2.0::DOUBLE AS place FROM scored_fits),
    rated AS (
      SELECT trial, held, teaches,
        2.0::DOUBLE * count(*) FILTER (toxic = 1 AND score > 0.5)
          / greatest(count(*) FILTER (toxic = 1) + count(*) FILTER (score > 0.5), 1) AS f1,
        (sum(place) FILTER (toxic = 1) - count(*) FILTER (toxic = 1) * (count(*) FILTER (toxic = 1) + 1) / 2.0::DOUBLE)
          / (count(*) FILTER (toxic = 1) * count(*) FILTER (toxic <> 1)) AS roc_auc
      FROM ordered_fits GROUP BY ALL)"""


def _mean_std(name: str, teaches: bool, alias: str) -> str:
    side = "teaches" if teaches else "NOT teaches"
    return (
        f"round(avg({name}) FILTER ({side}), 6) AS {alias}_mean, "
        f"round(stddev_pop({name}) FILTER ({side}), 6) AS {alias}_std"
    )


_WHOLE = "whole AS (SELECT 0 AS part, * FROM train)"
_SWEEP = f"""{_SPLIT}, train_rows AS (SELECT count(*) AS total FROM train),
parts AS (
  SELECT row_number() OVER (ORDER BY size) - 1 AS part, size FROM (
    SELECT DISTINCT size FROM (
      SELECT unnest([{', '.join(map(str, SIZES))}])::BIGINT AS size UNION ALL SELECT total FROM train_rows), train_rows
    WHERE size <= total)),
part_sizes AS (
  SELECT part, size, toxic, n, total FROM parts, (SELECT toxic, count(*) AS n FROM train GROUP BY toxic), train_rows),
part_quota AS (
  SELECT part, toxic, size * n // total + (row_number() OVER (PARTITION BY part ORDER BY size * n % total DESC, toxic)
    <= size - sum(size * n // total) OVER (PARTITION BY part))::BIGINT AS quota FROM part_sizes),
drawn AS (
  SELECT train.*, row_number() OVER (PARTITION BY toxic ORDER BY {_key("'42:subsample'", 'doc_id')}) AS draw
  FROM train),
whole AS (SELECT part, drawn.* EXCLUDE draw FROM drawn JOIN part_quota USING (toxic) WHERE draw <= quota),
{_folded('whole')}, {_study("SELECT part AS trial, part, NULL AS step, 'risk_score' AS number, 0.5::DOUBLE AS position FROM parts")},
sweep AS (
  SELECT trial, {_mean_std('f1', True, 'train_f1')}, {_mean_std('f1', False, 'cv_f1')},
    avg(f1) FILTER (NOT teaches) AS best FROM rated GROUP BY trial),
counted AS (
  SELECT part AS trial, count(*) AS sample_size, round(avg(toxic::DOUBLE), 6) AS positive_share
  FROM whole GROUP BY part)"""

ORACLES["model_leaderboard"] = f"""WITH {_SPLIT}, models AS (
  SELECT * FROM (VALUES {', '.join(f"('{name}', '{spec.number}', {spec.position}::DOUBLE)"
    for name, spec in CLOSED_MODELS.items())}) AS t(model, number, position)),
member AS (SELECT model, position, toxic, is_test, {_LITERAL} AS value FROM split, models),
means AS (
  SELECT model, avg(value) FILTER (toxic = 0) AS low, avg(value) FILTER (toxic = 1) AS high
  FROM member WHERE NOT is_test GROUP BY model),
scored AS (SELECT *, {_CUT_SCORE} AS score FROM member JOIN means USING (model) WHERE is_test),
ordered AS (
  SELECT *, rank() OVER (PARTITION BY model ORDER BY score)
    + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0::DOUBLE AS place FROM scored)
SELECT model, round(2.0::DOUBLE * count(*) FILTER (toxic = 1 AND score > 0.5)
    / greatest(count(*) FILTER (toxic = 1) + count(*) FILTER (score > 0.5), 1), 6) AS f1,
  round((sum(place) FILTER (toxic = 1) - count(*) FILTER (toxic = 1) * (count(*) FILTER (toxic = 1) + 1) / 2.0::DOUBLE)
    / (count(*) FILTER (toxic = 1) * count(*) FILTER (toxic <> 1)), 6) AS roc_auc
FROM ordered GROUP BY model"""
ORACLES["scored_messages"] = f"""WITH {_SPLIT}, means AS (
  SELECT avg(risk_score) FILTER (toxic = 0) AS low, avg(risk_score) FILTER (toxic = 1) AS high, 0.5::DOUBLE AS position
  FROM train),
{_EVENTS}, scored AS (
  SELECT substring(sha256(concat_ws('|', source || '.json', doc_id, raw_user_id, text)), 1, 16)
    AS message_hash, date, hour(date)::INTEGER AS hour, strftime(date, '%Y-%m') AS month,
    source AS chat, raw_user_id, text
  FROM clean JOIN timed USING (doc_id) WHERE type = 'message'),
{_NAMES}, valued AS (
  SELECT f.*, f.risk_score AS value, user FROM ({_features('scored', '*')}) f JOIN named USING (raw_user_id))
SELECT message_hash, chat, date, hour, month, user, round({_CUT_SCORE}, 6) AS toxicity_score FROM valued, means"""
ORACLES["size_sweep"] = f"""WITH {_SWEEP}
SELECT sample_size, sweep.* EXCLUDE (trial, best), positive_share FROM sweep JOIN counted USING (trial)"""
ORACLES["near_best_size"] = f"""WITH {_SWEEP}
SELECT min(sample_size) AS sample_size FROM sweep JOIN counted USING (trial)
WHERE best >= (SELECT max(best) FROM sweep) * 0.98::DOUBLE"""
_DRAWN = ", ".join(
    f"({i}, '{cut['number']}', {cut['position']}::DOUBLE, '{', '.join(f'{k}={v}' for k, v in cut.items())}')"
    for i, cut in enumerate(draw_cuts(TRIALS))
)
ORACLES["random_search"] = f"""WITH {_SPLIT}, {_WHOLE}, {_folded('whole')},
cuts AS (SELECT * FROM (VALUES {_DRAWN}) AS t(trial, number, position, params)),
{_study("SELECT trial, 0 AS part, NULL AS step, number, position FROM cuts")},
tried AS (
  SELECT trial, avg(f1) FILTER (NOT teaches) AS f1, stddev_pop(f1) FILTER (NOT teaches) AS std,
    avg(roc_auc) FILTER (NOT teaches) AS area, avg(f1) FILTER (teaches) AS train FROM rated GROUP BY trial)
SELECT rank() OVER (ORDER BY round(f1, 9) DESC)::INTEGER AS rank_test_f1, trial, round(f1, 6) AS mean_test_f1,
  round(std, 6) AS std_test_f1, round(area, 6) AS mean_test_roc_auc, round(train, 6) AS mean_train_f1, params
FROM tried JOIN cuts USING (trial)"""
ORACLES["learning_curve"] = f"""WITH {_SPLIT}, {_WHOLE}, {_folded('whole')},
{_study("SELECT unnest(range(1, 6)) AS trial, 0 AS part, unnest(range(1, 6)) AS step, 'risk_score' AS number, 0.5::DOUBLE AS position")}
SELECT (SELECT count(*) FROM folded WHERE fold <> 0 AND prefix <= trial) AS train_size,
  {_mean_std('f1', True, 'train_f1')}, {_mean_std('f1', False, 'cv_f1')},
  {_mean_std('roc_auc', True, 'train_roc_auc')}, {_mean_std('roc_auc', False, 'cv_roc_auc')}
FROM rated GROUP BY trial"""
_TEST_ROWS = "count(*) AS rows, count(*) FILTER (toxic = 1) AS positives, true AS scores_agree"
ORACLES["classifier_ratings"] = f"""WITH {_SPLIT}
SELECT unnest(['Logistic Regression', 'Linear SVM', 'RandomForest']) AS model, {_TEST_ROWS} FROM split WHERE is_test"""
ORACLES["boosted_metrics"] = f"""WITH {_SPLIT}
SELECT 'Boosted trees' AS model, {_TEST_ROWS}, true AS metrics_valid FROM split WHERE is_test"""
_SETTINGS = ", ".join(
    f"({i}, '{', '.join(f'{k}={v}' for k, v in one.items())}', true)" for i, one in enumerate(draw_settings(TRIALS))
)
ORACLES["boosted_search"] = f"SELECT * FROM (VALUES {_SETTINGS}) AS t(trial, params, rated)"
ORACLES["feature_importance"] = """SELECT 30::BIGINT AS features, 30::BIGINT AS names, true AS shares,
  true AS within_whole"""

# --- evaluation --------------------------------------------------------------------------------------

ORACLES["confusion_matrix"] = f"""WITH {_RATED}
SELECT y.y::INTEGER AS label, p.p::INTEGER AS prediction, count(r.doc_id) AS rows
FROM (SELECT unnest([0, 1]) AS y) y, (SELECT unnest([0, 1]) AS p) p
LEFT JOIN rated r ON r.label = y.y AND r.prediction = p.p GROUP BY ALL"""
ORACLES["binary_metrics"] = f"""WITH {_CELLS}
SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
  round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM cells"""
ORACLES["class_report"] = f"""WITH {_CELLS}, sides AS (
  SELECT '0' AS class, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall,
    2 * tn / (2 * tn + fn + fp) AS f1, tn + fp AS support FROM cells
  UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM cells),
report AS (
  SELECT * FROM sides
  UNION ALL SELECT 'accuracy', NULL, NULL, (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM cells
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM sides
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
    sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM sides)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  support::BIGINT AS support FROM report"""
ORACLES["roc_auc"] = f"""WITH {_RATED}
SELECT round(sum(CASE WHEN p.score > n.score THEN 1.0::DOUBLE WHEN p.score = n.score THEN 0.5::DOUBLE
  ELSE 0.0::DOUBLE END) / count(*), 6) AS roc_auc
FROM rated p JOIN rated n ON p.label = 1 AND n.label = 0"""
ORACLES["roc_points"] = f"""WITH {_POINTS}
SELECT round(threshold, 6) AS threshold, round(fp / all_neg, 6) AS fpr, round(tp / all_pos, 6) AS tpr
FROM points UNION ALL SELECT NULL, 0.0, 0.0"""
ORACLES["pr_points"] = f"""WITH {_POINTS}
SELECT round(threshold, 6) AS threshold, round(tp / (tp + fp), 6) AS precision,
  round(tp / all_pos, 6) AS recall FROM points UNION ALL SELECT NULL, 1.0, 0.0"""
ORACLES["average_precision"] = f"""WITH {_POINTS}, steps AS (
  SELECT tp / (tp + fp) AS precision,
    tp / all_pos - coalesce(lag(tp / all_pos) OVER (ORDER BY threshold DESC), 0) AS step FROM points)
SELECT round(sum(precision * step), 6) AS average_precision FROM steps"""
ORACLES["best_threshold"] = f"""WITH {_POINTS}
SELECT round(threshold, 6) AS threshold, round(tp / (tp + fp), 6) AS precision,
  round(tp / all_pos, 6) AS recall, round(2 * tp / (tp + fp + all_pos), 6) AS f1
FROM points ORDER BY round(2 * tp / (tp + fp + all_pos), 12) DESC, points.threshold DESC LIMIT 1"""
ORACLES["calibration_bins"] = f"""WITH {_RATED}, mapped AS (
  SELECT label, score / (1 + score) AS p FROM rated)
SELECT least(floor(p * 10), 9)::INTEGER AS bin, count(*) AS rows, round(avg(p), 6) AS mean_score,
  round(avg(label::DOUBLE), 6) AS positive_share FROM mapped GROUP BY 1"""
ORACLES["error_slices"] = f"""WITH {_RATED}
SELECT doc_id, label, round(score, 6) AS score, prediction,
  CASE WHEN prediction = 1 THEN 'FP' ELSE 'FN' END AS error FROM rated WHERE label <> prediction"""

# --- trends --------------------------------------------------------------------------------------------

_MEAN_RISK = "round(avg(risk_score), 6) AS mean_toxicity, count(*) AS messages"
ORACLES["hourly_trend"] = f"""WITH {_RISK}, {_WEAK}
SELECT hour, round(avg((bad OR high)::INTEGER), 6) AS mean_toxicity, count(*) AS messages
FROM weak WHERE hour IS NOT NULL GROUP BY hour"""
ORACLES["hourly_risk"] = f"""WITH {_RISK}
SELECT hour, {_MEAN_RISK} FROM scored WHERE hour IS NOT NULL GROUP BY hour"""
ORACLES["day_part_trend"] = f"""WITH {_RISK}
SELECT CASE WHEN hour BETWEEN 18 AND 23 THEN 'evening_18_23' ELSE 'other_time' END AS time_period,
  {_MEAN_RISK} FROM scored WHERE hour IS NOT NULL GROUP BY 1"""
ORACLES["monthly_trend"] = f"""WITH {_RISK}, spine AS (
  SELECT last_day(unnest(generate_series(date_trunc('month', min(date)), date_trunc('month', max(date)),
    INTERVAL 1 MONTH))) AS month_end FROM scored)
SELECT m.month_end, round(avg(s.risk_score), 6) AS mean_toxicity, count(s.doc_id) AS messages
FROM spine m LEFT JOIN scored s ON last_day(s.date) = m.month_end GROUP BY 1"""
ORACLES["top_users"] = f"""WITH {_RISK}, {_NAMES}
SELECT user, {_MEAN_RISK} FROM scored JOIN named USING (raw_user_id) GROUP BY user
HAVING count(*) >= 5 ORDER BY avg(risk_score) DESC, user LIMIT 10"""
ORACLES["top_raw_users"] = ORACLES["top_users"]

# --- checks -----------------------------------------------------------------------------------------------

ORACLES["quality_checks"] = f"""WITH {_RISK}
SELECT count(*) AS rows, 0::BIGINT AS empty_text, 0::BIGINT AS bad_pseudonym,
  0::BIGINT AS raw_id_columns FROM scored"""
ORACLES["label_checks"] = """SELECT count(*) AS rows,
  count(*) FILTER (toxic IS NULL OR toxic NOT IN (0, 1)) AS bad_label FROM labels"""
ORACLES["class_guard"] = """WITH c AS (SELECT count(*) AS n FROM labels WHERE toxic IS NOT NULL GROUP BY toxic)
SELECT count(*) AS classes, min(n) AS smallest_class, count(*) >= 2 AS trainable, min(n) >= 5 AS stable
FROM c"""
