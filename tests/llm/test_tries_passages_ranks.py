"""Conversation trie, passage removal and ranked search against brute force, and on awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from medalstar.llm import common, lexical, queries, substrings, trie
from tests.support import physical_plan

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(common.WORD)
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
EXTRA = ", _row string, _metadata string, file int, size string, score string, n string, prefix string"
EXTRAS = ("r", "m", 1, "s", "c", "n", "p")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- trie


def brute_trie(convs):
    """{(conv, depth): (parent, n_convs, n_children, n_leaves, saved, ends)} of {conv: [(role, text)]}."""
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out = {}

    def below(path):
        leaves, saved = (0, 0) if children[path] else (1, 0)
        saved += (len(members[path]) - 1) * (len(path[-1][1].encode()) if path else 0)
        for child in children[path]:
            a, b = below(child)
            leaves, saved = leaves + a, saved + b
        ends = sha(",".join(str(c) for c in members[path] if len(convs[c]) == len(path)))
        out[members[path][0], len(path)] = (
            members[path[:-1]][0] if path else None, len(members[path]), len(children[path]), leaves, saved, ends)
        return leaves, saved

    if convs:
        below(())
    return out


def trie_rows(nodes, ends):
    got = trie.ends_digest(nodes, ends).collect()
    found = {(r["conv"], r["depth"]): (r["parent"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved"], r["ends_sha256"])
             for r in got}
    assert len(found) == len(got)
    return found


def turns_by_conversation(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", sha(text or ""), text or ""))
    return {c: [(r, t) for _, _, r, _, t in sorted(x)] for c, x in convs.items()}


def many_conversations(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        length = rng.choice([1, 2, 3, 5, 9])
        rows += [(c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]),
                  rng.choice(["a", "b", "", None, "ü" * 3])) for t in range(length)]
    rows += [(500 + c, t, "user", f"same {t}") for c in range(40) for t in range(6)]  # copies
    rows += [(700, t, "user", f"long {t % 7}") for t in range(300)] + [(701, t, "user", f"long {t % 7}") for t in range(299)]
    rows += [(None, 1, "user", "lost"), (3, 1, "user", "twice"), (3, 1, "user", "twice")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells, block", [(trie.MOST_CELLS, trie._BLOCK), (16, 7)])
def test_trie_is_that_of_brute_force(spark, monkeypatch, cells, block):
    """Also with a saturated sketch, which proves next to nothing, and with conversations of many blocks."""
    monkeypatch.setattr(trie, "MOST_CELLS", cells)
    monkeypatch.setattr(trie, "_BLOCK", block)
    rows = many_conversations(1)
    frame = spark.createDataFrame([(*r, *EXTRAS) for r in rows], "conv_id bigint, turn bigint, role string, text string" + EXTRA)
    nodes, ends = trie.trie(frame)
    assert trie_rows(nodes, ends) == brute_trie(turns_by_conversation(rows))


def test_rebuilt_conversations(spark):
    rows = [(c, t, "user", f"{c} {t}") for c in (0, 1, 2, 3, 4, 11, 13, 14, 26, 27, 28, 29, 5, 6)
            for t in range(2 if c < 3 else 1 if c > 20 else 12)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns = common.staged(trie.numbered_turns(frame), "numbered")
    own = turns_by_conversation(rows)
    convs = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = own.get(c - c % 5, [])[:h] + mine[h:]
    assert any(not x for x in convs.values())  # a conversation without turns
    nodes, ends = trie.prefix_trie(*trie.rebuilt(turns, trie.lengths_of(turns)))
    assert trie_rows(nodes, ends) == brute_trie(convs)


def test_trie_of_nothing_and_of_one(spark):
    kind = "conv_id bigint, turn bigint, role string, text string"
    assert trie_rows(*trie.trie(spark.createDataFrame([], kind))) == {}
    one = spark.createDataFrame([(5, None, None, None)], kind)
    assert trie_rows(*trie.trie(one)) == brute_trie({5: [("", "")]})
    only = spark.createDataFrame([(3, 0), (9, 0)], "conv bigint, n bigint")
    none = spark.createDataFrame([], "conv bigint, depth bigint, digest binary, size bigint")
    assert trie_rows(*trie.prefix_trie(none, only)) == brute_trie({3: [], 9: []})


def test_singletons_are_not_grouped(spark):
    rows = [(c, t, "user", f"{c} {t}" if t else "hello") for c in range(200) for t in range(4)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns = trie.numbered_turns(frame)
    told = turns.withColumns({"a": F.xxhash64(F.lit(1), "depth", "digest", F.when(F.col("depth") > 1, F.col("conv")).otherwise(0)),
                              "b": F.xxhash64(F.lit(2), "depth", "digest", F.when(F.col("depth") > 1, F.col("conv")).otherwise(0))})
    marked = trie._screened(common.staged(told, "told")).groupBy("depth", "alone").count().collect()
    counts = {(r["depth"], r["alone"]): r["count"] for r in marked}
    assert counts[1, False] == 200 and sum(n for (d, alone), n in counts.items() if d > 1 and not alone) < 10


# --- passages


def brute_passages(texts, width):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def passages(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    line = [rng.choice(vocabulary) for _ in range(20)]
    texts = [None, "", "  \t\n", "short text", "a " * 36, "a " * 35, "a b c " * 14, "x y " * 40, " ".join(passage)]
    for _ in range(40):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(10, 200))]
        at = rng.randrange(len(own))
        cut = rng.randrange(20, 60)
        texts.append(rng.choice([" ", "\n", "\t "]).join(own[:at] + rng.choice([passage, passage[cut - 20 : cut + 16], line, []]) + own[at:]))
    texts += ["é" + "\r\n".join(passage[5:60]) + " ² end"] * 3
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(60_000)))  # very long
    return texts


@pytest.mark.parametrize("width, members", [(35, 4096), (35, 2), (12, 4096), (12, 3)])
def test_passages_are_those_of_brute_force(spark, monkeypatch, width, members):
    """Also where nearly every file counts as large and is split by whole prefixes."""
    monkeypatch.setattr(substrings, "FILE_SEGMENTS", members)
    texts = passages(width)
    rows = [(i if i % 7 else None, t, *EXTRAS) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string" + EXTRA)
    got = substrings.removed(frame, width=width).collect()
    expected = sorted(((rows[i][0], *x) for i, x in enumerate(brute_passages(texts, width))), key=repr)
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=repr) == expected
    for r in got:  # spans are maximal, ascending and add up
        ends = [x for s in r["spans"] for x in s]
        assert ends == sorted(ends) and len(set(ends)) == len(ends)
        assert sum(s["end"] - s["begin"] for s in r["spans"]) == r["n_removed"]


def test_passages_of_nothing_and_of_copies(spark):
    kind = "doc_id bigint, text string"
    assert substrings.removed(spark.createDataFrame([], kind)).collect() == []
    text = " ".join(f"w{i}" for i in range(50))
    rows = substrings.removed(spark.createDataFrame([(1, text), (1, text), (2, text + " more")], kind)).collect()
    assert sorted((r["doc_id"], r["n_removed"], r["kept"]) for r in rows) == [(1, 50, ""), (1, 50, ""), (2, 50, "more")]
    with pytest.raises(ValueError):
        substrings.removed(spark.createDataFrame([], kind), width=8)


def test_words_of_singular_files_are_not_fetched(spark):
    docs = common.chosen_rows(spark.read.parquet(f"{SMALL}/documents.parquet"), key="doc_id", text="text")
    found = substrings._segments(docs.select(F.coalesce("text", F.lit("")).alias("text"), "_row"), 35)
    total = found.agg(F.count("*").alias("n"), F.sum("size").alias("suffixes")).first()
    assert total["n"] < total["suffixes"] / 8  # a dozen neighbours travel as one


# --- ranked search


def brute_search(items, docs, k):
    found = [(key, Counter(TERM.findall((t or "").translate(LOWER)))) for key, t in docs]
    n = [sum(c.values()) for _, c in found]
    total, count = sum(n), sum(x > 0 for x in n)
    df = Counter(t for _, c in found for t in c)
    weight = {t: math.floor(1000 * math.log((2 * count + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        terms = set(TERM.findall((text or "").translate(LOWER)))
        scored = []
        for row, (key, c) in enumerate(found):
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * (10 + 90 * n[row] * count // total))) for t in terms & set(c))
            if score > 0:
                scored.append((-score, key is None, key or 0, row, key))
        out += [(item, rank, key, -s) for rank, (s, _, _, _, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("item_bytes, group, at_once", [(4 << 20, 8192, 64), (200, 16, 1)])
def test_search_is_that_of_brute_force(spark, monkeypatch, item_bytes, group, at_once):
    """Also in several blocks of items, small groups of documents and with a look at the k-th score after each mask."""
    for name, value in (("ITEM_BYTES", item_bytes), ("GROUP_ROWS", group), ("_AT_ONCE", at_once)):
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(4)
    vocabulary = ["the", "The", "é²", "x1", *[f"t{i}" for i in range(150)]]
    docs = [(i if i % 11 else None, rng.choice([" ", "-", "\x00", ".\n"]).join(
        rng.choice(vocabulary[: rng.choice([5, 40, 154])]) for _ in range(rng.randrange(60)))) for i in range(300)]
    docs += [(7, "t1 t2 t3")] * 5 + [(900, None), (901, ""), (902, "--"), (903, "t5 " * 30_000)]
    items = [(i, " ".join(rng.sample(vocabulary, rng.choice([1, 6, 30])))) for i in range(12)]
    items += [(20, None), (21, "?"), (22, "unknown"), (None, "t1 t9"), (3, "t1 t9"), (23, " ".join(vocabulary))]  # over 64 terms
    left = spark.createDataFrame([(*r, *EXTRAS) for r in items], "item_id bigint, text string" + EXTRA)
    right = spark.createDataFrame([(*r, *EXTRAS) for r in docs], "doc_id bigint, text string" + EXTRA).coalesce(3)
    got = lexical.search(left, right, k=7).collect()
    assert sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got], key=repr) == brute_search(items, docs, 7)


def test_search_in_nothing(spark):
    none, one = (spark.createDataFrame(rows, "item_id bigint, text string") for rows in ([], [(1, "a")]))
    docs = [spark.createDataFrame(rows, "doc_id bigint, text string") for rows in ([], [(1, "a b")])]
    assert [lexical.search(i, d).count() for i in (none, one) for d in docs] == [0, 0, 0, 1]


def test_queries_shuffle_no_texts(spark):
    plan = physical_plan(queries.op13_lexical(spark, SMALL))
    assert "text" not in plan and "CartesianProduct" not in plan
    assert "Cartesian" not in physical_plan(queries.op11_trie(spark, SMALL))
