"""Decontamination, top-k search, chat masks, archives and mixing against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textrisk.llm import chat, cover_tree, mixing, suffix_match, warc

# Decontamination ------------------------------------------------------------------------

TEXTS = "doc_id bigint, text string, spans string, n_words string"


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def brute_overlaps(text, items, width=10):
    words = plain_words(text)
    hit, found, longest = set(), set(), set()
    for item_id, item in items:
        own = plain_words(item)
        size = min(width, len(own))
        if item_id is None or not size:
            continue
        for i in range(len(words) - size + 1):
            for j in range(len(own) - size + 1):
                if words[i : i + size] != own[j : j + size]:
                    continue
                hit.update(range(i, i + size))
                found.add(item_id)
                if i and j and words[i - 1] == own[j - 1]:
                    continue
                n = size
                while i + n < len(words) and j + n < len(own) and words[i + n] == own[j + n]:
                    n += 1
                longest.add((item_id, i, j, n))
    return len(words), hit, sorted(found), longest


def overlap_case(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "ç", "d1", "Ee", "f-f", "g"]
    items = [
        (i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 4, 10, 11, 25])))) for i in range(8)
    ]
    items += [items[3], (None, "a a a"), (99, None)]
    texts = []
    for doc_id in range(40):
        words = rng.choices(vocabulary[:2] if doc_id % 5 == 0 else vocabulary, k=rng.randint(0, 60))
        if doc_id % 3 == 0:
            words += (rng.choice(items[:8])[1] or "").upper().split(" ")
        texts.append((doc_id, rng.choice([" ", ", ", "\n"]).join(words), "x", None))
    return texts + [(None, None, None, None), (41, "", None, None), (3, texts[3][1], "x", None)], items


@pytest.mark.parametrize("seed, block_bytes", [(1, 1 << 20), (2, 60)])
def test_overlaps_equal_brute_force(spark, seed, block_bytes):
    texts, items = overlap_case(seed)
    documents = spark.createDataFrame(texts, TEXTS).repartition(3)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = suffix_match.find_overlaps(documents, benchmark, block_bytes=block_bytes).collect()
    assert len(found) == len(texts)
    expected = {doc_id: brute_overlaps(text, items) for doc_id, text, *_ in texts}
    for row in found:
        n_words, hit, ids, longest = expected[row.doc_id]
        covered = {w for span in row.spans for w in range(span.start, span.end)}
        assert (row.n_words, covered, row["items"]) == (n_words, hit, ids)
        assert {tuple(m) for m in row.matches} == longest
        ends = [span.end for span in row.spans]
        assert all(a < span.start for a, span in zip(ends, row.spans[1:]))
    kept = suffix_match.remove_overlapping(documents, benchmark, block_bytes=block_bytes)
    assert kept.columns == documents.columns
    named = [(i, item) for i, (_, item) in enumerate(items)]  # items without id are searched too
    clean = sorted((str(d), str(t)) for d, t, *_ in texts if not brute_overlaps(t, named)[1])
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == clean


def test_overlaps_of_empty_tables_and_long_text(spark):
    benchmark = spark.createDataFrame([(1, "p q r s t u v w x y z")], "item_id bigint, text string")
    nothing = spark.createDataFrame([], TEXTS)
    assert suffix_match.find_overlaps(nothing, benchmark).count() == 0
    long = "k " * 300_000 + "p q r s t u v w x y z"
    documents = spark.createDataFrame([(1, long, None, None)], TEXTS)
    row = suffix_match.find_overlaps(documents, benchmark).collect()[0]
    assert [(s.start, s.end) for s in row.spans] == [(300_000, 300_011)]
    assert [tuple(m) for m in row.matches] == [(1, 300_000, 0, 11)]
    row = suffix_match.find_overlaps(documents, benchmark.where("false")).collect()[0]
    assert row.spans == [] and row.n_words == 300_011
    assert suffix_match.remove_overlapping(documents, benchmark.where("false")).count() == 1


# Top-k search ---------------------------------------------------------------------------


def brute_top(vectors, k):
    out = []
    unique = sorted({(i, tuple(v)) for i, v in vectors if i is not None and v is not None})
    for query in sorted({i for i, _ in unique if i % 20 == 0}):
        best = {}
        for i, q in unique:
            if i == query:
                for j, d in unique:
                    if j != query and len(d) == len(q):
                        score = sum(a * b for a, b in zip(q, d))
                        best[j] = max(best.get(j, score), score)
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(query, n, j, score) for n, (j, score) in enumerate(ranked, 1)]
    return out


@pytest.mark.parametrize("block_rows, leaf_rows", [(8192, 512), (37, 512), (8192, 6), (100, 3)])
def test_top_products_equal_brute_force(spark, block_rows, leaf_rows):
    rng = np.random.default_rng(5)
    centres = rng.integers(-60, 60, (5, 12))
    rows = [(i, (centres[i % 5] + rng.integers(-9, 9, 12)).tolist()) for i in range(400)]
    rows += [(500 + i, rows[0][1]) for i in range(60)]  # ties
    rows += [(0, rows[0][1]), (20, [1] * 12), (None, [1] * 12), (7, None), (600, [1, 2]), (601, [3, 4])]
    # one id with many vectors, some of them the best
    rows += [(800, (np.array(rows[i][1]) * 2).tolist()) for i in range(0, 400, 7)]
    frame = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>").withColumn("score", F.lit("x"))
    queries = frame.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    found = cover_tree.top_products(frame, queries, 20, block_rows, leaf_rows)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())
    assert got == sorted(brute_top(rows, 20))


def test_cover_tree_covers():
    rng = np.random.default_rng(2)
    vectors = np.concatenate([rng.normal(0, 5, (500, 8)), np.zeros((300, 8))])
    todo = [cover_tree.cover_tree(vectors)]
    while todo:
        node = todo.pop()
        apart = np.sqrt(((vectors[node.rows] - node.centre) ** 2).sum(axis=1))
        assert apart.max() <= node.radius + 1e-9
        if node.children:
            below = np.concatenate([child.rows for child in node.children])
            assert sorted(below) == sorted(node.rows)
            todo += node.children


def test_clusters_are_pruned():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (40, 16))
    centres *= 600 / np.sqrt((centres**2).sum(axis=1))[:, None]
    data = np.rint(centres[np.arange(8000) % 37] + rng.normal(0, 8, (8000, 16))).astype(np.int64)
    queries, ids = data[::20], np.arange(8000)
    search = cover_tree.DualSearch(queries, ids[::20], data, ids, 20, leaf_rows=32)
    search.run()
    share = search.compared / (len(queries) * len(data))
    assert share < 0.25, share
    scores = queries @ data.T
    scores[np.arange(len(queries)), ids[::20]] = -(10**12)
    order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=-1)[:, :20]
    assert (search.found == order).all()
    assert (search.scores == np.take_along_axis(scores, order, 1)).all()


def test_large_scores_are_exact():
    rng = np.random.default_rng(9)
    data = rng.integers(-(10**9), 10**9, (300, 8))
    data[7] = data[8] + 1  # scores that differ by less than doubles do
    ids = np.arange(300)
    search = cover_tree.DualSearch(data[:40], ids[:40], data, ids, 5, leaf_rows=16)
    search.run()
    for row in range(40):
        best = sorted((-sum(a * b for a, b in zip(data[row].tolist(), other)), i)
                      for i, other in enumerate(data.tolist()) if i != row)[:5]
        assert [(-s, i) for s, i in zip(search.scores[row].tolist(), search.found[row].tolist())] == best
    wide = np.full((2, 8), 3 * 10**9)
    with pytest.raises(ValueError):
        cover_tree.DualSearch(wide, np.array([0, 1]), wide, np.array([0, 1]), 1).run()


def test_scaled_and_empty(spark):
    rows = [([0.5, -0.01],), ([float("nan")],), ([float("inf")],), ([1.0, None],), (None,), ([],)]
    frame = spark.createDataFrame(rows, "embedding array<float>")
    got = [r[0] for r in frame.select(cover_tree.scaled("embedding")).collect()]
    assert got == [[32, -1], None, None, None, None, []]
    empty = spark.createDataFrame([], "vec_id bigint, vector array<bigint>")
    assert cover_tree.top_products(empty, empty.withColumnRenamed("vec_id", "query_id")).count() == 0


# Chat masks -----------------------------------------------------------------------------

PIECES = st.sampled_from(
    ["<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<", "|",
     "\\", "[", "]", ">", "/", "s>", " ", "\n", "a", "é", "日", "🙂", "<|endoftext|>", "\0"]
)
SAID = st.lists(PIECES, max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(SAID)
def test_escape_round_trip(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    for control in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"):
        assert control not in escaped


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "<|end|>"]), SAID), max_size=6))
def test_masks_round_trip(turns):
    tokenizer = chat.load_tokenizer(chat.TOKENIZER)
    formatted, lo, hi = chat.render(turns)
    assert chat.read_turns(formatted) == turns
    tokens = tokenizer.encode(formatted, add_special_tokens=False)
    offsets = np.array(tokens.offsets, np.int64).reshape(-1, 2)
    mask = chat.overlapping(offsets[:, 0], offsets[:, 1], lo, hi)
    said = "".join(text for role, text in turns if role == "assistant")
    assert chat.masked_text(formatted, offsets[:, 0], offsets[:, 1], mask) == said
    # No token of a mark is under the mask, and the masked ids alone say the same.
    marks = {tokenizer.token_to_id(mark) for mark in (chat.TURN, chat.TEXT, chat.END)}
    chosen = [i for i, on in zip(tokens.ids, mask) if on]
    assert not marks & set(chosen)
    wanted = "".join(chat.escape(text) for role, text in turns if role == "assistant")
    assert tokenizer.decode(chosen, skip_special_tokens=False) == wanted


def test_overlapping_equals_comparison_of_all():
    rng = random.Random(4)
    for _ in range(200):
        cuts = sorted(rng.sample(range(60), 2 * rng.randint(0, 6)))
        spans = np.array(cuts, np.int64).reshape(-1, 2)
        edges = sorted(rng.sample(range(61), rng.randint(2, 30)))
        tokens = np.array(list(zip(edges, edges[1:])), np.int64)
        got = chat.overlapping(tokens[:, 0], tokens[:, 1], spans[:, 0], spans[:, 1])
        assert got.tolist() == [any(a < e and s < b for s, e in spans) for a, b in tokens]


def test_chats_of_odd_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, turns string"
    rows = [
        (1, 2, "assistant", "second <|end|>", "x"), (1, 1, "user", "first", "x"), (1, None, None, None, None),
        (2, 1, "assistant", "same", "x"), (2, 1, "assistant", "same", "x"), (None, 1, "assistant", "z", None),
        (3, 1, "assistant", "long " * 50_000, None), (4, 1, "user", "", None),
    ]
    frame = spark.createDataFrame(rows, schema)
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(frame)).collect()}
    assert set(got) == {1, 2, None, 3, 4}
    assert [got[k].n_turns for k in (1, 2, None, 3, 4)] == [3, 2, 1, 1, 1]
    assert got[1].turns_sha256 == hashlib.sha256(b"\n\nuser\nfirst\nassistant\nsecond <|end|>\n").hexdigest()
    assert got[2].loss_sha256 == hashlib.sha256(b"samesame").hexdigest() and got[3].loss_chars == 250_000
    assert got[4].loss_chars == 0
    assert chat.read_back(chat.format_chats(frame.where("false"))).count() == 0


# Archives -------------------------------------------------------------------------------


@pytest.mark.parametrize("refers_to", [None, 3])
def test_record_round_trip(refers_to):
    payload = "é\r\n\r\nWARC/1.1\r\n".encode()
    digest = warc.payload_digest(payload)
    record = warc.encode_record(5, "http://a/b c\r\nd", payload, digest, refers_to)
    read = warc.decode_record(record)
    assert read["payload_bytes"] == len(payload) and read["payload_digest"] == digest
    assert read["payload"] == (payload if refers_to is None else None)
    assert (read["page_id"], read["refers_to"]) == (5, refers_to)
    assert read["record_type"] == ("response" if refers_to is None else "revisit")
    if refers_to is None:
        with pytest.raises(ValueError):
            warc.decode_record(record.replace("é".encode(), b"ee"))


def test_archives_round_trip(spark, tmp_path):
    schema = "page_id bigint, url string, html string, hash string, archive string"
    big = "<p>" + "x" * 300_000
    rows = [(i, f"http://h/{i}", f"<p>{i % 4}", "h", "a") for i in range(40)]
    rows += [(50, None, None, None, None), (51, "u", "", None, None), (None, "u", "<p>1", None, None),
             (60, "u", big, "h", "a"), (61, "u", big, "h", "a"), (7, "http://h/7", "<p>3", "h", "a"),
             (7, "other", "other", "h", "a")]
    pages = spark.createDataFrame(rows, schema).repartition(3)
    for least, size in ((0, 1 << 20), (4, 100)):
        folder = str(tmp_path / f"warc{least}")
        index = warc.write_archives(pages, folder, least, archive_bytes=size)
        assert index.count() == len(rows)
        read = warc.read_records(index, folder, range_bytes=1000).collect()
        first = {}
        for page_id, _, html, *_ in rows:
            if page_id is not None:
                first[html or ""] = min(first.get(html or "", page_id), page_id)
        expected = []
        for page_id, url, html, *_ in rows:
            payload = (html or "").encode()
            source = first.get(html or "")
            revisit = page_id is not None and source != page_id and len(payload) >= least
            expected.append(
                (page_id, url, "revisit" if revisit else "response", source if revisit else None,
                 len(payload), warc.payload_digest(payload))
            )
        got = [(r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in read]
        assert sorted(got, key=str) == sorted(expected, key=str)
        one = warc.read_records(index.where("page_id = 60"), folder).collect()
        assert [bytes(r.payload).decode() for r in one] == [big]
    nothing = warc.write_archives(pages.where("false"), str(tmp_path / "none"))
    assert warc.read_records(nothing, str(tmp_path / "none")).count() == 0


# Mixing ---------------------------------------------------------------------------------


def brute_mix(rows, target):
    import math

    words = lambda text: len(re.findall("[^\x20\x09-\x0d]+", text or ""))
    tokens = {}
    for _, source, text in rows:
        tokens[source] = tokens.get(source, 0) + words(text)
    tokens = {s: n for s, n in tokens.items() if n}
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items()}

    def measures(step):
        power = {s: p ** (step / mixing.GRID) for s, p in share.items()}
        norm = sum(power.values())
        weights = {s: p / norm for s, p in power.items()}
        entropy = -sum(w * math.log2(w) for w in weights.values())
        return weights, entropy, max(weights[s] / share[s] for s in share) * target.budget_share

    step = mixing.GRID
    if len(tokens) > 1:
        wanted = target.entropy_share * math.log2(len(tokens)) - 1e-9
        most = max(target.repetitions, target.budget_share) + 1e-9
        while step and measures(step)[1] < wanted:
            step -= 1
        while step < mixing.GRID and measures(step)[2] > most:
            step += 1
    out = []
    for source, weight in measures(step)[0].items() if tokens else ():
        exact = weight * total * target.budget_share
        budget = math.floor(exact + exact * 1e-12 + 1e-9)
        passes, rest = divmod(budget, tokens[source])
        own = [(doc_id, words(text)) for doc_id, s, text in rows if s == source]
        key = lambda d: hashlib.md5(f"{target.seed}:{passes}:{'' if d is None else d}".encode()).hexdigest()
        for doc_id, count in own:
            upto = sum(n for d, n in own if key(d) <= key(doc_id))
            epochs = list(range(passes)) + ([passes] if upto <= rest else [])
            out += [(doc_id, source, epoch, int(key(doc_id)[:3], 16), count) for epoch in epochs]
    return out


@pytest.mark.parametrize(
    "target",
    [mixing.MixTarget(), mixing.MixTarget(0.999, 2.0), mixing.MixTarget(0.2, 50.0, 2.5), mixing.MixTarget(1.0, 100.0, 0.3)],
)
def test_mix_equals_brute_force(spark, monkeypatch, target):
    monkeypatch.setattr(mixing, "GRID", 256)
    rng = random.Random(9)
    rows = [
        (i, rng.choices(["a", "b", "c", None], [60, 25, 5, 10])[0], "w " * rng.randint(0, 30)) for i in range(300)
    ]
    rows += [(1, rows[1][1], rows[1][2]), (400, "empty", None), (401, "empty", " "), (None, "a", "one two")]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    frame = frame.withColumn("mix_epoch", F.lit("clash")).withColumn("tokens", F.lit("x"))
    found = mixing.mix_sources(frame, target)
    assert found.columns == ["doc_id", "source", "text", "tokens", "mix_epoch", "mix_block", "mix_tokens"]
    got = [(r.doc_id, r.source, r.mix_epoch, r.mix_block, r.mix_tokens) for r in found.collect()]
    assert sorted(got, key=str) == sorted(brute_mix(rows, target), key=str)


def test_mix_of_empty_tables(spark):
    schema = "doc_id bigint, source string, text string"
    assert mixing.mix_sources(spark.createDataFrame([], schema)).count() == 0
    assert mixing.mix_sources(spark.createDataFrame([(1, "a", None)], schema)).count() == 0
    assert mixing.mix_sources(spark.createDataFrame([(1, "a", "x y")], schema)).count() == 1


def test_records_are_read_by_several_tasks(spark, tmp_path):
    pages = spark.range(400).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr("repeat(sha2(string(id), 512), 60)").alias("html")
    )
    index = warc.write_archives(pages.repartition(6), str(tmp_path / "a"))
    read = warc.read_records(index, str(tmp_path / "a"), range_bytes=20_000, task_bytes=20_000)
    assert read.rdd.getNumPartitions() > 4
    assert read.count() == 400
