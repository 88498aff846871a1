"""Each operator against brute force, a round trip or held-out accuracy, and on awkward tables."""

import base64
import hashlib
import random
import re
import uuid
import zlib
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from medalstar.llm import (
    ann, bpe, chat, common, exact_dedup, langid, mixing, near_dedup, quality, queries, token_counts, warc,
)

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, file string, size int, score string"
WORD = re.compile(common.WORD)
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def awkward(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows, clashing names of further columns."""
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, base, "en", "a"), (2, base.replace(" ", "\t\n"), "en", "a"), (3, None, None, None), (4, "", "en", "b"),
        (5, LONG, "en", "b"), (6, LONG + " tail", None, "b"), (None, base, "en", None), (8, "   ", "en", "c"),
        (9, "word", "en", "c"), (9, "word", "en", "c"), (10, "WORD", "de", "c"), (11, "x" * 3000 + " é½²", "fr", "c"),
        (12, base + " thirteen", "en", None), (13, "<|endoftext|> a<|endoftext|>", "en", "a"),
    ]
    return spark.createDataFrame([(i, t, g, s, None, "f", 1, "s") for i, t, g, s in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_components(rows, width):
    """{row number: smallest key of its component}"""
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    keys = {}
    for i, (key, _) in enumerate(rows):
        keys.setdefault(find(i), []).append(key)
    return [(key, len(sets[i]), min((k for k in keys[find(i)] if k is not None), default=None))
            for i, (key, _) in enumerate(rows)]


# --- operator 3


def library():
    return Tokenizer.from_file(queries.vocabulary_path())


def test_bpe_agrees_with_the_library():
    rng = random.Random(5)
    letters = "ab  \n\t'sre<|>é字  \x1c½²1_-!\U0001f600́\x00"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["", "a" * 4000, "ab" * 100, "<|endoftext|> x<|endoftext|>", " " * 70, "it's  we're\n\n they'll ", LONG[:5000]]
    encoder, known = bpe.Encoder(bpe.load_vocabulary(queries.vocabulary_path())), library()
    for _ in range(2):  # the second time from memory
        values, offsets = encoder.encode(pa.array(texts))
        decoded = encoder.decode(values, offsets)
        for i, text in enumerate(texts):
            ids = known.encode(text, add_special_tokens=False).ids
            assert values[offsets[i] : offsets[i + 1]].tolist() == ids, text
            assert decoded[i] == known.decode(ids, skip_special_tokens=False)


def test_line_ends_at_the_edges_take_the_fast_path(monkeypatch):
    known, encoder = library(), bpe.Encoder(bpe.load_vocabulary(queries.vocabulary_path()))
    plain = ["a turn that ends\n", "\nbegins so", " one blank first", "\n", "mid\nline and\n"]
    runs = ["two ends\n\n", "\n\n", " \n", "blank then end \n", "\n x", "", " ", "ends in blank ", "  two", "long" * 300 + "\n"]
    for texts in (plain, runs, plain + runs):
        values, offsets = encoder.encode(pa.array(texts))
        for text, a, b in zip(texts, offsets, offsets[1:]):
            assert values[a:b].tolist() == known.encode(text, add_special_tokens=False).ids, repr(text)
    monkeypatch.setattr(encoder, "encode_one", None)
    encoder.encode(pa.array(plain))
    assert max(map(len, encoder.units)) <= bpe.LONGEST


@pytest.mark.parametrize("table", [documents, awkward, empty])
def test_bpe_digests(spark, table):
    known = library()
    got = bpe.digests(bpe.encode_decode(table(spark), queries.vocabulary_path())).collect()
    expected = []
    for row in table(spark).select("doc_id", "text").collect():
        ids = known.encode(row["text"] or "", add_special_tokens=False).ids
        text = known.decode(ids, skip_special_tokens=False)
        expected.append((row["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


# --- operator 7


@pytest.mark.parametrize("table", [documents, awkward, empty])
def test_exact_dedup(spark, table):
    rows = [(r["doc_id"], re.sub(common.SPACE, " ", r["text"] or "")) for r in table(spark).collect()]
    groups = {}
    for key, text in rows:
        groups.setdefault(text, []).append(key)
    expected = sorted(str((k, min((x for x in groups[t] if x is not None), default=None), len(groups[t]),
                           hashlib.sha256(t.encode()).hexdigest())) for k, t in rows)
    got = exact_dedup.deduplicate(table(spark)).collect()
    assert sorted(str((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in got) == expected
    assert sorted(r["text_sha256"] for r in got if r["kept"]) == sorted({r["text_sha256"] for r in got})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_golomb_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (1, 1 << 45), (5, 8), (3000, 1 << 44), (200, 1 << 47)):
        values = np.unique(rng.integers(0, top, n))
        flags = rng.random(len(values)) < 0.3
        back, marks = exact_dedup.golomb_decode(exact_dedup.golomb_encode(values, flags))
        assert back.tolist() == values.tolist() and marks.tolist() == flags.tolist()


# --- operator 10


@pytest.mark.parametrize("table, width", [(documents, 2), (awkward, 2), (awkward, 5), (empty, 5)])
def test_near_dedup(spark, table, width):
    rows = [(r["doc_id"], r["text"]) for r in table(spark).collect()]
    got = near_dedup.deduplicate(table(spark), width=width).collect()
    assert sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == sorted(
        map(str, brute_components(rows, width)))
    with_words = [r for r in got if r["n_shingles"]]
    assert sum(r["kept"] for r in with_words) == len({r["component_id"] for r in with_words})


def test_near_dedup_of_a_large_group_near_the_threshold(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    got = near_dedup.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string"), width=2).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows, 2)


def test_sketch_agrees_as_often_as_sets_are_similar():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    b = np.concatenate((a[:300], np.unique(rng.integers(0, 2**63, 100).astype(np.uint64))))
    coordinates = near_dedup.sketches(np.repeat([0, 1], [len(a), len(b)]), np.concatenate((a, b)), 2)
    assert (coordinates != near_dedup._EMPTY).all()
    assert abs((coordinates[0] == coordinates[1]).mean() - 300 / 500) < 0.1


# --- operator 6


def water_level(sizes, weights=mixing.WEIGHTS):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        free -= set(over)
        left = sum(sizes.values()) - sum(target.values())
    return target


@pytest.mark.parametrize("table", [documents, awkward, empty])
def test_mixing(spark, table):
    got = mixing.taken(table(spark)).drop("_row").collect()
    rows = table(spark).collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
    assert len(got) == len(rows)
    target, by_target = water_level(sizes), {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_target[round(r["target"], 3)] = by_target.get(round(r["target"], 3), 0) + r["taken"]
    assert sum(r["taken"] for r in got) == pytest.approx(sum(target.values()), abs=len(target))
    for value, words in by_target.items():
        alike = [t for t in target.values() if round(t, 3) == value]
        assert alike and abs(words - sum(alike)) <= len(alike)
    again = mixing.taken(table(spark)).drop("_row").collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixing_plan_has_no_python(spark):
    plan = mixing.taken(documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- operators 1 and 5


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 4 == 2


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op1_quality(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == q for p, q in judged) / len(judged) > 0.9


def test_language_on_held_out_rows(spark):
    lang = {r["doc_id"]: r["lang"] for r in documents(spark).collect()}
    got = [r for r in queries.op5_langid(spark, SMALL).collect()]
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    out = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in out) / len(out) > 0.95


def test_classifiers_on_awkward_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (9, None, 0), (None, 1, 0), (12, 7, 0)],
                                   "doc_id bigint, quality int, toxic int")
    for docs in (awkward(spark), empty(spark)):
        scored = quality.score(docs, quality.fit(docs, labels)).collect()
        assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
        named = langid.predict(docs, langid.fit(docs)).collect()
        assert all((r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", r["text"] or "")) for r in named)
    none = quality.fit(awkward(spark), labels.limit(0))
    assert {r["score"] for r in quality.score(awkward(spark), none).collect()} == {0.5}
    nothing = langid.predict(awkward(spark), langid.fit(empty(spark))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


# --- operator 4


def expected_chat(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by_conv.items():
        turns.sort()
        texts = [(r, t) for _, _, r, t in turns]
        loss = "".join(t for r, t in texts if r == "assistant")
        out.append((conv, len(texts), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in texts).encode()).hexdigest(),
                    len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(map(str, out))


AWKWARD_TURNS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "a\\b <|im_end|>\n<|im_start|>user\nno <|<|im_end|> \\[INST]"),
    (2, 0, "user", "hello"), (2, 1, "assistant", "other"), (2, 2, "user", "more"), (3, 0, "user", "hello"),
    (4, 0, None, None), (4, 1, "role\nwith \\n line", ""), (5, None, "assistant", "last"), (5, 0, "user", "x" * 5000),
    (6, 0, "user", "same"), (6, 0, "user", "same"), (None, 0, "assistant", "no id"), (7, 0, "user", "hello"),
    (7, 1, "assistant", "other"), (7, 2, "user", "less"),
]


def test_chat_round_trip(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    for frame in (spark.createDataFrame(AWKWARD_TURNS, schema).withColumn("depth", F.lit("clash")),
                  spark.read.parquet(f"{SMALL}/conversations.parquet"), spark.createDataFrame([], schema)):
        nodes, paths = chat.format_tree(frame, queries.vocabulary_path())
        got = chat.read_back(nodes, paths).collect()
        rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
        assert sorted(str(tuple(r)[:5]) for r in got) == expected_chat(rows)


def test_chat_layout(spark):
    frame = spark.createDataFrame(AWKWARD_TURNS, "conv_id bigint, turn bigint, role string, text string")
    nodes, paths = (x.collect() for x in chat.format_tree(frame, queries.vocabulary_path()))
    at, by_conv = {n["node"]: n for n in nodes}, {}
    for p in sorted(paths, key=lambda p: p["depth"]):
        by_conv.setdefault(p["conv_id"], []).append(p["node"])
    assert len(nodes) == len({tuple(v[:i]) for v in by_conv.values() for i in range(1, len(v) + 1)})
    sequences = {}
    for n in nodes:
        sequences.setdefault(n["tree"], []).append((n["start"], n["start"] + len(n["ids"])))
    for spans in sequences.values():  # every token once, without gaps
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for way in by_conv.values():
        seen = []
        for node in way:
            n = at[node]
            assert n["position"] == len(seen)
            assert [i for a in n["attends"] for i in range(a["begin"], a["end"])] == seen
            seen += range(n["start"], n["start"] + len(n["ids"]))


# --- operator 2


def test_edited_counts_equal_counts_of_the_edited_text(spark):
    known, docs = library(), awkward(spark).unionByName(documents(spark).limit(40), allowMissingColumns=True)
    edits = token_counts.sample_edits(docs).unionByName(spark.createDataFrame(
        [(1, None, 3, 2, "'"), (5, 9, 10**9, 5, None), (6, 9, -4, None, "<|endof"), (99, 1, 0, 0, "none")],
        "doc_id bigint, seq bigint, start bigint, cut bigint, insert string"))
    own = {}
    for e in edits.collect():
        own.setdefault(e["doc_id"], []).append((e["seq"] is not None, e["seq"] or 0, max(e["start"] or 0, 0),
                                                max(e["cut"] or 0, 0), e["insert"] or ""))
    expected = []
    for r in docs.collect():
        text = r["text"] or ""
        before = len(known.encode(text, add_special_tokens=False).ids)
        for _, _, start, cut, insert in sorted(own.get(r["doc_id"], [])):
            start = min(start, len(text))
            text = text[:start] + insert + text[start + cut :]
        expected.append(str((r["doc_id"], before, len(known.encode(text, add_special_tokens=False).ids), len(text))))
    got = token_counts.apply_edits(docs, edits, queries.vocabulary_path()).collect()
    assert sorted(str((r["doc_id"], r["tokens_before"], r["tokens_after"], r["chars_after"])) for r in got) == sorted(expected)
    assert all(sum(r["leaf_tokens"]) == r["tokens_after"] and (not r["leaf_tokens"] or r["sums"][1] == r["tokens_after"])
               for r in got)
    long = next(r for r in got if r["doc_id"] == 5)
    assert long["chars_again"] < long["chars_after"] / 10


def test_edits_of_a_repeated_key_stream_behind_each_row(spark):
    known = library()
    docs = common.with_rows(common.staged(spark.createDataFrame(
        [(1, f"some words, row {i}") for i in range(40)] + [(2, LONG[:9000]), (None, "no key")], "doc_id bigint, text string"), "docs"))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # a document's edits come in several batches
    try:
        edits = token_counts.sample_edits(docs, by=common.ROW)
        counts = token_counts.apply_edits(docs, edits, queries.vocabulary_path(), by=common.ROW)
        assert sorted((r["doc_id"] or 0, r["edits"]) for r in counts.collect()) == [(0, 0)] + [(1, 4)] * 40 + [(2, 4)]
        many = spark.createDataFrame([(1, i, i, i % 3, f"e{i}") for i in range(50)] + [(3, 0, 0, 0, "x")],
                                     "doc_id bigint, seq bigint, start bigint, cut bigint, insert string")
        counts = token_counts.apply_edits(docs, many, queries.vocabulary_path())
        assert "collect_list" not in counts._jdf.queryExecution().toString()
        got = counts.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    expected = []
    for r in docs.collect():
        text = r["text"]
        for i in range(50 if r["doc_id"] == 1 else 0):
            start = min(i, len(text))
            text = text[:start] + f"e{i}" + text[start + i % 3 :]
        expected.append((r["doc_id"] or 0, len(known.encode(text, add_special_tokens=False).ids), len(text)))
    assert sorted((r["doc_id"] or 0, r["tokens_after"], r["chars_after"]) for r in got) == sorted(expected)


def test_random_edits_keep_the_tree_right():
    encoder, rng, known = bpe.Encoder(bpe.load_vocabulary(queries.vocabulary_path())), random.Random(8), library()
    letters = "ab  \n's re<|endoftext|>1!é"
    text = "".join(rng.choice(letters) for _ in range(3000))
    tree = token_counts.SegmentTree(*token_counts.leaves_of(encoder, token_counts.pre_tokens(encoder, text)))
    for _ in range(150):
        insert = rng.choice(["", "<|endoftext|>", "   ", "'re", "x" * 50, "\n\n", "".join(rng.choices(letters, k=300))])
        text, _ = token_counts.edit(encoder, tree, text, rng.randint(0, len(text)), rng.randint(0, 40), insert)
        assert tree.tokens == len(known.encode(text, add_special_tokens=False).ids)
        assert tree.chars[1] == len(text)


def test_few_characters_are_encoded_again(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    counts = token_counts.apply_edits(docs, token_counts.sample_edits(docs), queries.vocabulary_path())
    again, after = counts.agg(F.sum("chars_again"), F.sum("chars_after")).first()
    assert again < 0.3 * after


def test_edits_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_counts.apply_edits(docs, token_counts.sample_edits(docs), queries.vocabulary_path()).count() == 0


# --- operator 8


def brute_records(rows, least=0):
    out = []
    for key, html in rows:
        payload = (html or "").encode()
        same = [k for k, h in rows if (h or "").encode() == payload and k is not None]
        first = min(same, default=None)
        revisit = len(payload) >= least and first is not None and key != first
        out.append((key, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("least", [0, 8])
def test_archives(spark, least):
    schema = "page_id bigint, url string, html string, range int, time string"
    odd = spark.createDataFrame([
        (1, "http://a.org/x", "WARC/1.1\r\n\r\ntext\r\n\r\n"), (2, "http://a.org/x", "same payload"), (3, None, "same payload"),
        (4, "https://www.b.org:444/%41\r\nX: y", None), (5, "http://[bad", ""), (None, "http://a.org", "no id"),
        (6, "http://a.org/é?q=1", "é" * 5000), (0, "http://c.org", "same payload"),
    ], "page_id bigint, url string, html string").selectExpr("*", "1 AS range", "'x' AS time")
    for pages in (odd, spark.read.parquet(f"{SMALL}/pages.parquet"), spark.createDataFrame([], schema)):
        got = warc.archive_and_index(pages, least=least).collect()
        rows = [(r["page_id"], r["html"]) for r in pages.collect()]
        assert sorted(str(tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")))
                      for r in got) == brute_records(rows, least)
        assert sorted(str((r["page_id"], r["url"])) for r in got) == sorted(
            str((r["page_id"], r["url"])) for r in pages.collect())
        history = [(r["urlkey"], r["time"], r["page_id"] is None, r["page_id"] or 0)
                   for r in sorted(got, key=lambda r: (r["range"], r["place"]))]
        assert history == sorted(history)


def test_archives_are_the_same_again(spark, folder, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 4096)
    rows = [(i % 90, f"http://a.org/{i % 30}", "x" * (i % 7)) for i in range(120)] + [(None, None, None)] * 3
    pages = common.staged(spark.createDataFrame(rows, "page_id bigint, url string, html string"), "pages")
    written = []
    for name in ("a", "b"):
        warc.write_archives(pages, f"{folder}/{name}")
        files = sorted(Path(folder, name).glob("part-*"))
        assert len(files) > 5
        written.append({(f.name[:10], h["WARC-Record-ID"], h.get("X-Page-Id"), h.get("WARC-Target-URI"))
                        for f in files for _, _, h, _ in warc.parse(f.read_bytes())})
    assert written[0] == written[1] and len(written[0]) == len(rows)
    ids = [re.fullmatch("<urn:uuid:(.*)>", i)[1] for _, i, _, _ in written[0]]
    assert len(set(ids)) == len(rows) and all(str(uuid.UUID(i)) == i and uuid.UUID(i).version == 5 for i in ids)


def test_captures_of_a_url_stand_in_order_of_time(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 4096)  # many files, so many runs
    rows = [(i, f"http://a.org/{i % 3}", f"p{i}", None if i == 40 else f"2024-03-{30 - i % 30:02d} 10:00:00.{i:06d}")
            for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, seen string").withColumn(
        "seen", F.col("seen").cast("timestamp"))
    got = sorted(warc.archive_and_index(pages, time="seen").collect(), key=lambda r: (r["range"], r["place"]))
    when = {i: "2025-01-01T00:00:00.000000Z" if t is None else t.replace(" ", "T") + "Z" for i, _, _, t in rows}
    assert [(r["page_id"], r["time"]) for r in got] == [
        (i, when[i]) for i, *_ in sorted(rows, key=lambda r: (r[0] % 3, when[r[0]], r[0]))]
    assert len({r["file"] for r in got}) > 5


def test_payloads_longer_than_a_file_and_runs_longer_than_a_batch(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 18)
    rows = [(i, f"http://h{i % 7}.org/{i % 50}", "x" * 2_000_000 if i in (5, 900) else f"page {i % 3000}") for i in range(12_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        got = sorted(warc.archive_and_index(pages).collect(), key=lambda r: (r["range"], r["place"]))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len({r["file"] for r in got}) > 10
    assert [r["page_id"] for r in got] == [i for _, i in sorted((warc.url_key(u), i) for i, u, _ in rows)]
    sizes = {i: len(t) for i, _, t in rows}
    first = {}
    for i, _, t in rows:
        first.setdefault(t, i)
    assert all(r["payload_bytes"] == sizes[r["page_id"]] for r in got)
    assert {r["page_id"]: r["refers_to"] for r in got} == {i: first[t] if first[t] != i else None for i, _, t in rows}


def test_loser_tree_merges():
    rng = random.Random(4)
    for k in range(0, 9):
        runs = [sorted(rng.randint(0, 50) for _ in range(rng.randint(0, 30))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs], lambda x: x)) == sorted(x for r in runs for x in r)


# --- operator 9


def brute_nearest(rows, k):
    out = []
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v
            and np.isfinite(v).all() and np.any(v)]
    good = [(i, v) for i, v in good if len(v) == 3]
    for i, v in good:
        if i % 2 == 0:
            best = sorted((-float((v * w).sum()), j) for j, w in good if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def test_nearest_neighbours_of_awkward_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [round(float(x), 2) for x in rng.normal(size=3)]) for i in range(40)]
    rows += [(100 + i, [1.0, 0.0, 0.0]) for i in range(30)]
    rows += [(200, None), (202, []), (204, [0.0, 0.0, 0.0]), (206, [None, 1.0, 1.0]), (208, [float("nan"), 1.0, 1.0]),
             (210, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (212, [1.0, 2.0]), (214, [100.0, 5.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("list", F.lit("clash"))
    for k in (5, 500):
        got = sorted(map(tuple, ann.search(frame, F.col("vec_id") % 2 == 0, k=k).collect()))
        expected = brute_nearest(rows, k)
        assert [g[:3] for g in got] == [e[:3] for e in expected]
        assert np.allclose([g[3] for g in got], [e[3] for e in expected], rtol=0, atol=1e-12)
    assert not ann.search(frame.limit(0), F.col("vec_id") % 2 == 0).collect()


def test_recall_of_nearest_neighbours(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = frame.select("vec_id", "embedding").toPandas()
    ids, vectors = rows["vec_id"].to_numpy(), np.array(rows["embedding"].tolist(), dtype=float)
    got = ann.search(frame, F.col("vec_id") % 20 == 0).toPandas().groupby("query_id")["vec_id"].apply(set)
    asked = np.flatnonzero(ids % 20 == 0)
    scores = vectors[asked] @ vectors.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :20]
    hits = sum(len(got[ids[q]] & set(ids[b])) for q, b in zip(asked, best))
    assert hits / best.size >= 0.9


def test_tight_groups_get_all_their_neighbours(spark):
    rng = np.random.default_rng(9)
    rows, groups = list(np.eye(8)[0] + 0.1 * rng.normal(size=(3000, 8))), []
    for size, centre in zip((10, 2, 19, 5), (-np.eye(8)[0], np.eye(8)[1], -np.eye(8)[2], np.eye(8)[5])):
        groups.append(set(range(len(rows), len(rows) + size)))
        rows += list(1.6 * centre + 1e-6 * rng.normal(size=(size, 8)))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>")
    asks = (F.col("vec_id") % 20 == 0) | (F.col("vec_id") >= 3000)
    got = ann.search(frame, asks, k=20).toPandas().groupby("query_id")["vec_id"].apply(list)
    assert len(got) == 150 + 36 and all(len(set(x)) == len(x) == 20 for x in got)
    assert all(group - {i} <= set(got[i]) for group in groups for i in group)


def test_ids_with_many_vectors_get_neighbours(spark):
    rng = np.random.default_rng(10)
    rows = [(7, [1.0 + 1e-3 * float(x), 0.0, 0.0]) for x in range(60)]
    rows += [(100 + i, [float(x) for x in rng.normal(size=3) / 9]) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [r for r in ann.search(frame, F.col("vec_id") == 7, k=5, index=ann.Index(probes=8, targets=16)).collect()]
    scores = sorted(((-float(np.dot(v, w)), j) for i, v in rows if i == 7 for j, w in rows if j != 7))[:5]
    assert [(r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [
        (n, j) for n, (_, j) in enumerate(scores, 1)]


def test_a_walk_opens_all_of_its_best_in_a_round():
    rng = np.random.default_rng(11)
    centroids, queries = rng.normal(size=(900, 6)), rng.normal(size=(4, 6))
    graph, looks = ann.Graph(centroids, 16), []

    class Counted:
        def __getitem__(self, nodes, near=graph.near):
            looks.append(1)
            return near[nodes]

    graph.near = Counted()
    found, far = graph.search(queries, 300)
    assert len(looks) <= 4 * 12  # one by one there are at least 300
    for query, mine, distance in zip(queries, found, far):
        exact = ((centroids - query) ** 2).sum(axis=1)
        assert np.array_equal(distance, exact[mine]) and (np.diff(distance) >= 0).all() and len(set(mine)) == 300
        assert len(set(mine) & set(np.argsort(exact)[:300])) >= 297


def test_a_shelf_compares_the_vectors_of_the_asked_lists_once():
    rng = np.random.default_rng(12)
    n, keep = 700, 6
    vectors = np.round(rng.normal(size=(n, 5)), 1)  # many equal scores
    lists = [sorted({int(x) for x in rng.integers(0, 30, size=rng.integers(1, 5))}) for _ in range(n)]
    parts = [pa.record_batch([pa.array([x[-1] for x in lists[i : i + 50]]), pa.array(lists[i : i + 50]), pa.array(range(i, i + 50)),
                              pa.array(vectors[i : i + 50].tolist())], ["list", "lists", "class", "v"]) for i in range(0, n, 50)]
    shelf = ann.Shelf(parts, 16)
    assert len(shelf.vectors) == n and max(b - a for a, b in shelf.parts) == 16
    asked, questions = rng.random((70, 30)) < 0.15, np.round(rng.normal(size=(70, 5)), 1)
    asked[3] = False
    asks = pa.record_batch([pa.array(range(70)), pa.array(questions.tolist()),
                            pa.array([x.tobytes() for x in np.packbits(asked, axis=1)], pa.binary())], ["q", "v", "asked"])
    number, ids, scores = ann._best_of_shelf(shelf, asks, keep)
    for q, question in enumerate(questions):
        all_of = sorted((-float((vectors[i] * question).sum()), i) for i in range(n) if asked[q, lists[i]].any())
        assert sorted(zip(-scores[number == q], ids[number == q])) == all_of[:keep]


# --- pipeline


def test_pipeline_stages(spark):
    docs = documents(spark)
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality_classifier" and len(corpus_pipeline.STAGES) == 5
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = kept.collect()
        kept = common.staged(stage(spark, kept, SMALL), name)
        rows = kept.collect()
        if name != "bpe":
            assert kept.columns == docs.columns
            assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in before}
        if name == "exact_dedup":
            norm = lambda t: re.sub(common.SPACE, " ", t or "")
            assert {r["doc_id"] for r in rows} == set(pd.DataFrame(
                [(norm(r["text"]), r["doc_id"]) for r in before]).groupby(0)[1].min())
        if name == "minhash_near_dedup":
            expected = brute_components([(r["doc_id"], r["text"]) for r in before], 5)
            assert sorted(r["doc_id"] for r in rows) == sorted({c if n else k for k, n, c in expected})
        if name == "bpe":
            assert len(rows) == len(before)


def test_stages_on_frames_that_are_not_stored(spark):
    made, keys = awkward(spark), sorted(map(str, (1, 3, 5, 6, 8, 9, 10, 11, 12, 13)))
    stored = common.staged(made, "awkward")
    twice = stored.join(spark.range(2).withColumnRenamed("id", "copy"), how="cross").drop("copy")
    for docs in (made, twice):
        once = corpus_pipeline.exact_deduplication(spark, docs, SMALL)
        assert once.columns == docs.columns and sorted(str(r["doc_id"]) for r in once.collect()) == keys
    mixed = corpus_pipeline.source_mixing(spark, made, SMALL)
    assert mixed.columns == made.columns
    assert mixed.count() == corpus_pipeline.source_mixing(spark, stored, SMALL).count() > 0
    near = corpus_pipeline.near_deduplication(spark, made, SMALL)
    assert near.columns == made.columns and near.count() < made.count()


def test_stages_on_awkward_tables(spark):
    for docs in (awkward(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, common.staged(docs, "awkward"), SMALL)
            if name != "bpe":
                assert result.columns == docs.columns
            assert len(result.collect()) <= 3 * docs.count()
    once = corpus_pipeline.exact_deduplication(spark, common.staged(awkward(spark), "awkward"), SMALL).collect()
    assert sorted(str(r["doc_id"]) for r in once) == sorted(map(str, (1, 3, 5, 6, 8, 9, 10, 11, 12, 13)))


def test_encoding_works_on_bounded_batches_and_leaves_no_memory_behind(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.unset(name)
    try:
        bpe.encode_decode(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), queries.vocabulary_path())
        assert int(spark.conf.get(name)) <= 8 << 20
        spark.conf.set(name, "12345")  # a bound of the caller's own stays
        common.bound_batches(spark)
        assert spark.conf.get(name) == "12345"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    encoder = bpe.Encoder(bpe.load_vocabulary(queries.vocabulary_path()))
    texts = pa.array(["some words to remember", "and others"])
    first = [x.tolist() for x in encoder.encode(texts)]
    assert encoder.units
    encoder.forget()
    assert not encoder.units and not encoder.counts
    assert [x.tolist() for x in encoder.encode(texts)] == first


def test_sums_of_shingles_need_little_memory_beside_the_text():
    import tracemalloc

    text = "word " * 100_000
    expected = common.shingle_sets(["word word word"], 2)
    tracemalloc.start()
    owner, shingle = common.shingle_sets([text], 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert shingle.tolist() == expected[1].tolist()
    assert peak < 30 * len(text)
