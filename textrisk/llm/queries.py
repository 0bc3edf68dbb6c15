"""Named queries of the training-data operators, and the SQL of those that have one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textrisk.llm import (
    byte_bpe,
    chat,
    cover_tree,
    html_text,
    language,
    mixing,
    ngram_join,
    phrases,
    privacy,
    quality,
    spelling,
    suffix_match,
    warc,
)
from textrisk.session import staged, staged_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _remainder(column: str, parts: int):
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(parts))


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.similar_components(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select(
        "doc_id", F.coalesce(_remainder("doc_id", 5) == 0, F.lit(True)).alias("held_out"), "text"
    )
    stats = staged(quality.with_statistics(documents, ["doc_id", "held_out"]))
    labels = _table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit_discriminant(stats.where("not held_out").join(labels, "doc_id"))
    return quality.score_quality(stats, model).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int")
    )


def op3_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return html_text.extract_text(pages, html_text.fit_node_trees(pages))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents")).select(
        "doc_id", "source", "mix_epoch", "mix_block", "mix_tokens"
    )


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = staged_folder(spark, "warc")
    index = warc.write_archives(_table(spark, folder, "pages"), archives)
    return warc.read_records(index, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    held_out = F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False))
    profiles = language.fit_profiles(documents.where(~held_out))
    return language.predict_language(
        documents, profiles, [F.col("doc_id"), held_out.alias("held_out")]
    )


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_match.find_overlaps(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )
    length = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    names = F.array_sort(F.transform("items", lambda item: item.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        length.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_chats(rows.unionByName(added)))


def op9_top_products(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select(
        "vec_id", cover_tree.scaled("embedding").alias("vector")
    )
    queries = vectors.where(F.col("vec_id") % 20 == 0).withColumnRenamed("vec_id", "query_id")
    return cover_tree.top_products(vectors, queries)


def op10_privacy(spark: SparkSession, folder: str) -> DataFrame:
    found = privacy.find_personal_data(_table(spark, folder, "documents"))
    base = F.col("base")
    return found.select(
        "doc_id",
        *[privacy.count_of(base, kind).alias(f"n_{kind}") for kind in privacy.KINDS],
        F.sha2(privacy.listed(base), 256).alias("base_sha256"),
        privacy.listed(F.concat(base, F.col("terms"))).alias("spans"),
    )


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = byte_bpe.encode_texts(_table(spark, folder, "documents"))
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    counted = encoded.select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        "token_ids",
    )
    return byte_bpe.decode_tokens(counted).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(spelling.word_counts(_table(spark, folder, "documents")))


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_quality": op2_quality,
    "op3_html": op3_html,
    "op4_mixing": op4_mixing,
    "op5_warc": op5_warc,
    "op6_language": op6_language,
    "op7_decontamination": op7_decontamination,
    "op8_chat": op8_chat,
    "op9_top_products": op9_top_products,
    "op10_privacy": op10_privacy,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_phrases": op12_phrases,
    "op13_spelling": op13_spelling,
}

_LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWERED)

_SPACED = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"
_ESCAPED = r"regexp_replace({0}, '(<)(\\*)(\||/?s>|</?SYS>>)|(\[)(\\*)(/?INST\])', '\1\4\2\5\\\3\6', 'g')"

ORACLES: dict[str, str] = {
    "op4_mixing": f"""
        WITH doc AS (
            SELECT doc_id, source, coalesce({_SPACED}, 0)::BIGINT AS mix_tokens FROM documents
        ), src AS (
            SELECT source, sum(mix_tokens)::BIGINT AS tokens FROM doc GROUP BY source
            HAVING sum(mix_tokens) > 0
        ), share AS (
            SELECT source, tokens, tokens / (SELECT sum(tokens) FROM src)::DOUBLE AS share FROM src
        ), step AS (
            SELECT s AS step, log2(sum(pow(share, s / 4096.0::DOUBLE))) - sum(pow(share, s / 4096.0::DOUBLE)
                    * log2(pow(share, s / 4096.0::DOUBLE))) / sum(pow(share, s / 4096.0::DOUBLE)) AS entropy,
                max(pow(share, s / 4096.0::DOUBLE) / share) / sum(pow(share, s / 4096.0::DOUBLE)) AS most
            FROM share, range(0, 4097) AS t(s) GROUP BY s
        ), spread AS (
            SELECT max(step) AS step FROM step
            WHERE entropy >= 0.97 * log2((SELECT count(*) FROM src)) - 1e-9 OR step = 0
        ), chosen AS (
            SELECT min(step) AS step FROM step
            WHERE step >= (SELECT step FROM spread) AND (most <= 4 + 1e-9 OR step = 4096)
        ), raised AS (
            SELECT source, tokens, pow(share, (SELECT step FROM chosen) / 4096.0::DOUBLE) AS power FROM share
        ), exact AS (
            SELECT source, tokens, power / (SELECT sum(power) FROM raised)
                * (SELECT sum(tokens) FROM src)::DOUBLE AS exact FROM raised
        ), budget AS (
            SELECT source, tokens, floor(exact + exact * 1e-12::DOUBLE + 1e-9::DOUBLE)::BIGINT AS budget
            FROM exact
        ), plan AS (
            SELECT *, budget // tokens AS passes, budget % tokens AS rest FROM budget
        ), keyed AS (
            SELECT doc_id, doc.source, mix_tokens, passes, rest,
                md5('42:' || passes || ':' || coalesce(doc_id::VARCHAR, '')) AS key
            FROM doc JOIN plan ON doc.source IS NOT DISTINCT FROM plan.source
        ), ranked AS (
            SELECT *, sum(mix_tokens) OVER (PARTITION BY source ORDER BY key RANGE UNBOUNDED PRECEDING)
                AS upto FROM keyed
        ), given AS (
            SELECT *, unnest(range(0, passes)) AS mix_epoch FROM ranked
            UNION ALL SELECT *, passes AS mix_epoch FROM ranked WHERE upto <= rest
        )
        SELECT doc_id, source, mix_epoch, ('0x' || substr(key, 1, 3))::INTEGER AS mix_block, mix_tokens
        FROM given
    """,
    "op5_warc": """
        WITH page AS (
            SELECT page_id, coalesce(html, '') AS html FROM pages
        ), hashed AS (
            SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex,
                min(page_id) OVER (PARTITION BY html) AS first
            FROM (SELECT page_id, html FROM page)
        )
        SELECT page_id, payload_bytes,
            array_to_string(list_transform(range(0, 32), lambda i: substr(
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(hex, (i // 4)::INT * 5 + 1, 5))::INT)
                >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first THEN first END AS refers_to
        FROM hashed
    """,
    "op8_chat": rf"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), shown AS (
            SELECT *, {_ESCAPED.format('role')} AS shown_role, {_ESCAPED.format('text')} AS shown_text
            FROM said
        ), whole AS (
            SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                sum(length(shown_role) + length(shown_text) + 23) AS formatted_chars
            FROM shown GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
            sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM whole
    """,
    "op9_top_products": """
        WITH usable AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
            FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, d.vec_id, max(list_inner_product(q.v, d.v))::BIGINT AS score
            FROM usable q JOIN usable d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v)
            WHERE q.vec_id % 20 = 0 GROUP BY ALL
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op7_decontamination": f"""
        WITH item AS (
            SELECT DISTINCT item_id, {_PLAIN_WORDS.format('text')} AS w FROM benchmark
            WHERE item_id IS NOT NULL AND text IS NOT NULL
        ), win AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size,
                array_to_string(list_slice(w, pos, pos + least(len(w), 10) - 1), ' ') AS key
            FROM item, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(pos)
            WHERE len(w) > 0
        ), doc AS (
            SELECT doc_id, {_PLAIN_WORDS.format("coalesce(text, '')")} AS w FROM documents
        ), place AS (
            SELECT doc_id, pos, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS key
            FROM doc, (SELECT DISTINCT size FROM win), unnest(range(1, len(w) - size + 2)) AS t(pos)
        ), hit AS (
            SELECT doc_id, pos, win.size, item_id FROM place JOIN win USING (key)
            WHERE place.size = win.size
        ), per AS (
            SELECT doc_id, count(DISTINCT word) AS n_hit FROM (
                SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM hit
            ) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
            coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN per USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op12_phrases": rf"""
        WITH piece AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                {_LOWERED.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
        ), worded AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece
        ), total AS (
            SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
        ), counted AS (
            SELECT lang, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS phrase,
                count(*) AS f
            FROM worded, (SELECT unnest(range(1, 6)) AS size), unnest(range(1, len(w) - size + 2)) AS t(pos)
            GROUP BY ALL HAVING count(*) >= 100
        ), cut AS (
            SELECT lang, size, phrase, f AS a, k,
                array_to_string(list_slice(string_split(phrase, ' '), 1, k), ' ') AS head,
                array_to_string(list_slice(string_split(phrase, ' '), k + 1, size), ' ') AS tail
            FROM counted, unnest(range(1, size)) AS t(k) WHERE size > 1
        ), scored AS (
            SELECT cut.lang, cut.phrase, a, k, x.f AS l, y.f AS r, n,
                ((1000::HUGEINT * a::HUGEINT * n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT))::BIGINT AS score
            FROM cut JOIN counted x ON x.lang = cut.lang AND x.phrase = head
            JOIN counted y ON y.lang = cut.lang AND y.phrase = tail JOIN total ON total.lang = cut.lang
        ), lowest AS (
            SELECT * FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), within AS (
            SELECT DISTINCT lang, f, array_to_string(list_slice(string_split(phrase, ' '), pos, pos + part - 1), ' ')
                AS phrase
            FROM counted, unnest(range(2, size)) AS s(part), unnest(range(1, size - part + 2)) AS t(pos)
        ), ranked AS (
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
                phrase, a, l, r, n, score
            FROM lowest WHERE NOT EXISTS (
                SELECT 1 FROM within WHERE within.lang = lowest.lang AND within.phrase = lowest.phrase
                    AND 100 * within.f >= 100 * a)
        )
        SELECT * FROM ranked WHERE rank <= 2000
    """,
}
