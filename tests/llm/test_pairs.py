"""Jaccard join, decontamination, packing and sharding against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slackline.llm import decontamination as deco
from slackline.llm import jaccard, packing, queries, sharding
from slackline.llm import shingles as sh
from slackline.session import BATCH_ROWS, small_batches
from tests.llm import edge


def word_shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(rows):
    """(doc_id, class id, links) of every row."""
    texts = sorted({t for _, t in rows if t is not None})
    sets = {t: word_shingles(t) for t in texts}
    partners, parent = defaultdict(set), {t: t for t in texts}

    def top(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                partners[a].add(b)
                partners[b].add(a)
                parent[top(a)] = top(b)
    ids = defaultdict(list)
    for i, t in rows:
        if t is not None and i is not None:
            ids[top(t)].append(i)
    out = Counter()
    for i, t in rows:
        out[(i, i if t is None else min(ids[top(t)], default=None), len(partners[t]) if t is not None else 0)] += 1
    return out


def near_copies(n, words=60):
    """A chain of texts in which neighbours differ by a word, and one group changed at one place."""
    base = [f"w{k}" for k in range(words)]
    rows = [(1000 + i, " ".join(base[:-1] + [f"end{i}"])) for i in range(n)]
    moving = list(base)
    for i in range(n):
        moving[(7 * i) % words] = f"new{i}"
        rows.append((2000 + i, "a b c d e f " + " ".join(moving)))
    return rows


def as_counter(df):
    return Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in df.collect())


def test_classes_match_brute_force(spark):
    df = edge.documents(spark)
    df = df.select("doc_id", "text").union(spark.createDataFrame(near_copies(40), "doc_id long, text string"))
    assert as_counter(jaccard.join_similar(df)) == brute_classes(edge.texts_of(df))


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    rows = near_copies(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "GROUP_ROWS", 100)
    assert as_counter(jaccard.join_similar(df)) == brute_classes(rows)


def test_one_row_of_each_class_stays(spark):
    df = edge.documents(spark)
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    classes = {c for _, c, _ in brute_classes(edge.texts_of(df))}
    assert set(ids) == classes
    assert all(n == 1 for i, n in ids.items() if i is not None)


def test_components_of_a_long_chain(spark):
    edges = [(f"{i:04d}".encode(), f"{i + 1:04d}".encode()) for i in range(300)] + [(b"x", b"y"), (b"z", b"z")]
    got = {bytes(r["tid"]): bytes(r["component"]) for r in jaccard.components(spark.createDataFrame(edges, "tid binary, root binary")).collect()}
    assert {v for k, v in got.items() if k[:1] in b"0123456789"} - {b"0000"} == set()
    assert got[b"y"] == b"x"


def test_pruning_bounds():
    assert jaccard.needed(30) <= jaccard.needed(60) <= jaccard.needed(150)
    assert jaccard.needed(150) < 0.8 * 150
    rng = np.random.default_rng(3)
    draws = rng.random((20_000, 150)) < 0.8
    for hashes in range(30, 151, 30):
        assert (draws[:, :hashes].sum(axis=1) < jaccard.needed(hashes)).mean() < 1e-3


def test_minima_estimate_the_similarity():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, size=1000, dtype=np.uint64)
    b = np.concatenate([a[:900], rng.integers(0, 1 << 63, size=100, dtype=np.uint64)])
    m = jaccard.minima(np.concatenate([a, b]), np.array([0, 1000]))
    assert abs((m[0] == m[1]).mean() - 900 / 1100) < 0.1


def test_shingles_of_short_rows():
    words = np.arange(1, 12, dtype=np.uint64)
    found, owner, first = sh.shingles(words, np.array([0, 2, 0, 5, 4, 0]))
    assert owner.tolist() == [1, 3, 4]
    assert first.tolist() == [0, 0, 0]
    assert len(set(found.tolist())) == 3


def item_shingles(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_items(docs, items):
    out = set()
    for i, t in docs:
        have = item_shingles(t)
        for j, x in items:
            want = item_shingles(x)
            if want and len(want & have) >= 0.8 * len(want) - 1e-9:
                out.add((i, j, len(want), len(want & have)))
    return out


def test_items_match_brute_force(spark):
    rng = np.random.default_rng(8)
    word = lambda: f"v{rng.integers(0, 5000)}"
    items = [(j, " ".join(word() for _ in range(n))) for j, n in enumerate([3, 5, 9, 14, 36, 59, 150, 700])]
    items += [(None, None), (90, ""), (91, items[3][1]), (3, items[3][1])]
    docs = edge.texts_of(edge.documents(spark).select("doc_id", "text"))
    for k, (_, text) in enumerate(items[:8]):
        w = text.split()
        filler = [word() for _ in range(900)]
        docs.append((100 + k, " ".join(filler[:400] + w + filler[400:])))
        docs.append((200 + k, " ".join(filler[:17] + w[: len(w) // 2] + filler[17:600] + w[len(w) // 2 :])))
        docs.append((300 + k, text.upper().replace(" ", ", ")))
        docs.append((400 + k, " ".join(filler[:50] + w[: -max(1, len(w) // 10)])))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in deco.find(d, b).collect()}
    assert got == brute_items(docs, items)
    kept = Counter(r["doc_id"] for r in deco.drop_contaminated(d, b).collect())
    bad = {i for i, *_ in brute_items(docs, items)}
    assert kept == Counter(i for i, _ in docs if i not in bad)


def test_documents_are_searched_once(spark, monkeypatch):
    """One Python operator a task: every further one is a further worker with its own memory."""
    plans = []

    def watched(df, keep=deco.stored):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df)

    monkeypatch.setattr(deco, "stored", watched)
    items = spark.createDataFrame([(1, edge.PROSE)], "item_id long, text string")
    assert deco.find(edge.documents(spark), items).count() > 0
    assert [p.count("ArrowEvalPython") for p in plans] == [1, 1]


def test_python_gets_few_texts_at_a_time(spark, monkeypatch, conf):
    """Whole texts and their words reach Python in batches of at most 1000 rows; the setting stays the user's."""
    seen = []

    def watched(df, keep=deco.stored):
        if "Arrow" in df._jdf.queryExecution().executedPlan().toString():
            seen.append(int(spark.conf.get(BATCH_ROWS)))
        return keep(df)

    for module in (deco, jaccard, packing):
        monkeypatch.setattr(module, "stored", watched)
    docs, items = edge.documents(spark), spark.createDataFrame([(1, edge.PROSE)], "item_id long, text string")
    size = spark.conf.get(BATCH_ROWS)
    deco.find(docs, items)
    jaccard.classes(docs)
    packing.pack_documents(docs, queries.tokenizer())
    assert seen[1:] == [1000] * 4 and spark.conf.get(BATCH_ROWS) == size  # first, the items' signatures
    conf(BATCH_ROWS, "10")
    rows = spark.range(0, 50, 1, 1)
    count = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches)
    with small_batches(spark, 20):
        assert [r["n"] for r in rows.mapInArrow(count, "n long").collect()] == [10] * 5
    with small_batches(spark, 5):
        assert [r["n"] for r in rows.mapInArrow(count, "n long").collect()] == [5] * 10
    assert spark.conf.get(BATCH_ROWS) == "10"


def test_no_items(spark):
    df = edge.documents(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert deco.find(df, none).count() == 0
    out = deco.drop_contaminated(df, none)
    assert (out.count(), out.columns) == (df.count(), df.columns)


def encoded(text):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(queries.tokenizer()).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 0], dtype="<u4")


PARTS = [
    "a", "bc", "the", "It's", "don't", "...", "&&&", ".", ",", "'", "'s", "\u2019", "é", "É", "e\u0301", "ü", "ß", "语言", "😀", " ", "  ",
    "\n", "\t", "\xa0", "12", "3", "½", "a.b", "x,", "y!", "(z)", '"q"', "<|endoftext|>", "<|ENDOFTEXT|>", "İ", "ſ", "K", "…",
    ".'", "'.", "ª", "ǆ", "_", "-", "--", "\u200b", "\x00", "\x7f", "'re", "I'LL", "word's.", "naïve,", "ﬁ", "\u0300", ".\u0300",
    "q\u0300.", "९", "ⅷ",
]


def test_part_lookup_matches_the_tokenizer_on_random_texts(monkeypatch):
    """Also with a table that is emptied all the time."""
    from tokenizers import Tokenizer

    rng = random.Random(12)
    tokenizer = Tokenizer.from_file(queries.tokenizer())
    for cache in (packing.CACHE, 40):
        monkeypatch.setattr(packing, "CACHE", cache)
        words = packing.WordIds(queries.tokenizer())
        for _ in range(40):
            texts = ["".join(rng.choice(PARTS) + " " * (rng.random() < 0.3) for _ in range(rng.randint(0, 30))) for _ in range(100)]
            for text, ids in zip(texts, words.of(texts), strict=True):
                assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_pieces_match_the_tokenizer(spark):
    df = edge.documents(spark)
    odd = [
        (50, "a<|endoftext|>b <|startoftext|> C"), (54, "A<|EndOfText|>B., End. x.,\ny."), (51, "tab\tand wide space\x1cthere"),
        (52, "ΟΔΟΣ ΟΔΟΣ. é ́x it's we'll 12345"), (53, "\n\n  \n"),
    ]
    df = df.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    rows = packing.pack_documents(df, queries.tokenizer(), with_ids=True).collect()
    want = Counter()
    for i, t in edge.texts_of(df):
        ids = encoded(t)
        for k, low in enumerate(range(0, len(ids), 2048)):
            part = ids[low : low + 2048]
            want[(i, k, low, len(part), zlib.crc32(part.tobytes()), part.tobytes())] += 1
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in rows)
    assert got == want
    check_places(rows)


def check_places(rows, capacity=2048):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(6))
def test_plans_are_gapless_and_near_the_least(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(2048, rng.geometric([1 / 500, 1 / 90, 1 / 1500, 1 / 700, 0.5, 1 / 300][seed], size=3000))
    counts = Counter(int(x) for x in lengths)
    moves, bins = packing.plan(counts)
    placed = Counter()
    fill = defaultdict(list)
    for length, rank, first, each, offset, n in sorted(moves):
        assert rank == placed[length]
        placed[length] += n * each
        for b in range(first, first + n):
            fill[b] += [(offset + k * length, length) for k in range(each)]
    # The last piece of a length may leave part of a move's last bin empty, never the reverse.
    assert all(placed[x] == counts[x] for x in counts)
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    least = max(-(-int(lengths.sum()) // 2048), int((lengths > 1024).sum()))
    assert len(fill) == bins <= 1.02 * least + 1


def test_plan_of_nothing():
    assert packing.plan({}) == ([], 0)


def test_empty_table_packs_to_nothing(spark):
    assert packing.pack_documents(edge.documents(spark).limit(0), queries.tokenizer()).count() == 0


def shard_rows(df):
    return sharding.shard_documents(df).collect()


def test_shards_hold_groups_whole_and_near_equal(spark, monkeypatch):
    monkeypatch.setattr(sharding.balance, "__defaults__", (24, 300))
    rng = np.random.default_rng(2)
    data = [(i, "é" * int(rng.integers(0, 400)) + f"{i % 2500}") for i in range(3000)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    rows = shard_rows(df)
    assert len(rows) == 3000
    loads, by_text = Counter(), defaultdict(set)
    text = dict(data)
    for r in rows:
        loads[r["shard"]] += r["size"]
        by_text[text[r["doc_id"]]].add(r["shard"])
        assert r["size"] == len(text[r["doc_id"]].encode()) + 8
        assert r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
    assert all(len(s) == 1 for s in by_text.values())
    assert set(loads) == set(range(24))
    assert max(loads.values()) - min(loads.values()) <= 8
    check_slots(rows)


def check_slots(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_edge_rows(spark):
    df = edge.documents(spark)
    rows = shard_rows(df)
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in edge.texts_of(df))
    assert {r["size"] for r in rows if r["doc_id"] == 3} == {8}
    assert len({r["shard"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    check_slots(rows)
    assert shard_rows(df.limit(0)) == []


def test_differencing_beats_dealing_in_order():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 10_000, size=400)
    loads = np.zeros((400, 7), dtype=np.int64)
    loads[:, 0] = sizes
    goes, total = sharding.difference(loads)
    again = np.zeros(7, dtype=np.int64)
    np.add.at(again, goes[:, 0], sizes)
    assert again.tolist() == total.tolist()
    assert total.max() - total.min() < 20


def test_pipeline_stages_match_brute_force(spark):
    import corpus_pipeline as cp
    from slackline.session import stored

    folder = "/root/testdata/sf0.001"
    docs = queries.table(spark, folder, "documents")
    columns = docs.columns
    before = edge.texts_of(docs)
    for name, stage in cp.STAGES[:-1]:
        docs = stored(stage(spark, docs, folder))
        assert docs.columns == columns, name
        after = edge.texts_of(docs)
        if name == "n-gram Jaccard join":
            assert Counter(i for i, _ in after) == Counter({c for _, c, _ in brute_classes(before)})
        if name == "benchmark decontamination":
            items = [(r["item_id"], r["text"]) for r in queries.table(spark, folder, "benchmark").collect()]
            bad = {i for i, *_ in brute_items(before, items)}
            assert sorted(i for i, _ in after) == sorted(i for i, _ in before if i not in bad)
        if name == "PII":
            assert sorted(i for i, _ in after) == sorted(i for i, _ in before)
            assert not any(re.search(r"\w@\w+\.\w", t) for _, t in after)
        before = after
    last = cp.STAGES[-1][1](spark, docs, folder).collect()
    assert {r["doc_id"] for r in last} == {i for i, _ in before}
    check_places(last)
    assert len(cp.run(spark, folder).collect()) == len(last)


def test_extra_columns_pass_through_the_stages(spark):
    import corpus_pipeline as cp

    docs = edge.documents(spark)
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == edge.documents(spark).columns
    assert docs.where(F.col("kept") != "k").count() == 0
