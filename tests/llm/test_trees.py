"""Prefix trie, Merkle manifest and mixing of sources against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from slackline.llm import merkle, mixing, trie
from slackline.llm.common import running, stored
from tests.llm import edge

CONVERSATIONS = "conv_id long, turn long, role string, text string, hi string, depth int, conv string, pos long"


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def crc(number):
    return zlib.crc32(str(number).encode())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def as_rows(df):
    return Counter(tuple(r) for r in df.collect())


# --- running sums ---------------------------------------------------------------------------


def test_running_sums_over_chunks(spark, conf):
    conf("spark.sql.shuffle.partitions", "7")
    rows = [("hot" if i % 3 else f"g{i % 5}", None if i % 11 == 0 else i % 17, i % 4) for i in range(600)]
    df = stored(spark.createDataFrame(rows, "g string, o long, v long"))
    got = running(df, ["g"], ["o"], {"before": "v"}, chunk_rows=50).collect()
    for group in {r["g"] for r in got}:
        mine = sorted((r for r in got if r["g"] == group), key=lambda r: (r["o"] is not None, r["o"] or 0, r["before"]))
        total = 0
        for r in sorted(mine, key=lambda r: (r["before"], r["o"] is not None, r["o"] or 0)):
            assert r["before"] == total or r["v"] == 0
            total = r["before"] + r["v"]
        assert max(r["before"] + r["v"] for r in mine) == sum(r["v"] for r in mine)
        order = [r["o"] if r["o"] is not None else -1 for r in sorted(mine, key=lambda r: r["before"] + r["v"])]
        assert order[0] <= order[-1]


# --- prefix trie ----------------------------------------------------------------------------


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            said = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, said, (role, text)))
    own = {c: [x[-1] for x in sorted(v, key=lambda x: x[:3])] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        h = crc(c) % 4
        full[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(set)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    out = Counter()
    for node, who in members.items():
        below = [m for m in members if m[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(c for c in who if len(full[c]) == len(node)))
        saved = sum((len(members[m]) - 1) * n_words(m[-1][1]) for m in below if m)
        parent = min(members[node[:-1]]) if node else None
        leaves = sum(children[m] == 0 for m in below)
        out[(min(who), len(node), parent, len(who), children[node], leaves, saved, sha(ends))] += 1
    return out


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], CONVERSATIONS)


def random_rows(seed, convs=60, most=12):
    """Conversations that share long beginnings, some whole, with nulls, ties and repeated rows."""
    rng = random.Random(seed)
    rows, kept = [], [[]]
    for c in rng.sample(range(-30, 300), convs):
        start = rng.choice(kept)
        start = start[: rng.randint(0, len(start))]
        turns = start + [(rng.choice(["user", "bot", None]), rng.choice(["a b", "c", "", None, "d\te f"])) for _ in range(rng.randint(0, most))]
        if not turns:
            turns = [("user", "a b")]
        kept.append(turns)
        rows += [(c, None if i == 0 and c % 2 else i, *t) for i, t in enumerate(turns)]
    rows += rows[:9] + [(None, 0, "user", "no id"), (7, None, None, None), (7, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_matches_brute_force(spark, seed):
    rows = random_rows(seed)
    assert as_rows(trie.prefix_trie(conversations(spark, rows), batches=(4, 24, 64), block=4)) == brute_trie(rows)


def test_caterpillar_and_copies(spark):
    """One long conversation, others that leave it at every depth or end inside it, and copies."""
    chain = [("user", f"word{i} and more") for i in range(40)]
    rows = [(20, i, *t) for i, t in enumerate(chain)]
    for k in range(40):
        for copy in range(3):
            c = 1000 + 20 * (3 * k + copy)  # a multiple of 20 is rebuilt from itself
            rows += [(c, i, *t) for i, t in enumerate(chain[: k + 1])]
            if copy == 2:
                rows.append((c, 99, "bot", "away"))
    assert as_rows(trie.prefix_trie(conversations(spark, rows), batches=(2, 8, 64), block=8)) == brute_trie(rows)


def test_turnless_and_empty(spark):
    alone = next(c for c in range(21, 40) if crc(c) % 4 > 1)
    rows = [(alone, 0, "user", "skipped, for its base is absent")]
    assert as_rows(trie.prefix_trie(conversations(spark, rows))) == brute_trie(rows)
    assert trie.prefix_trie(conversations(spark, []).limit(0)).collect() == []
    assert trie.prefix_trie(conversations(spark, [(None, 1, "user", "a")])).collect() == []


def test_long_text_is_a_turn(spark):
    rows = [(40, 0, "user", "long " * 200_000), (40, 1, "bot", "x" * 500_000), (60, 0, "user", "long " * 200_000)]
    assert as_rows(trie.prefix_trie(conversations(spark, rows))) == brute_trie(rows)


def test_ends_in_pieces(spark):
    ids = spark.range(1000).select(F.col("id").alias("conv"), F.lit(5).cast("long").alias("hi"), (F.col("id") % 2).alias("lo"))
    got = {r["lo"]: r["ends_sha256"] for r in trie._ends(ids, chunk=16).collect()}
    assert got == {k: sha(",".join(str(i) for i in range(k, 1000, 2))) for k in (0, 1)}


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", trie.two_fattest("a", "b").alias("f"))
    for r in df.collect():
        assert r["f"] == max(range(r["a"] + 1, r["b"] + 1), key=lambda x: x & -x)


# --- Merkle manifest ------------------------------------------------------------------------


def brute_manifest(rows, arity=2):
    def text(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def levels(leaves):
        out = [leaves]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + arity])) for i in range(0, len(out[-1]), arity)])
        return out

    def way(tree, i):
        for level in tree[:-1]:
            first = i - i % arity
            yield level[first:i], level[i + 1 : first + arity]
            i //= arity

    def leaf(doc, plus=0):
        i, source, lang, n_chars, body = doc
        return sha("".join(map(text, (i, source, lang, None if n_chars is None else n_chars + plus, body))))

    groups = defaultdict(list)
    for doc in rows:
        groups[doc[2]].append(doc)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
        trees[lang] = levels([leaf(d) for d in groups[lang]])
    above = levels([trees[lang][-1][0] for lang in langs])
    out = Counter()
    for k, lang in enumerate(langs):
        for i, doc in enumerate(groups[lang]):
            steps = [*way(trees[lang], i), *way(above, k)]
            start = leaf(doc, 1) if doc[0] is not None and crc(doc[0]) % 7 == 0 else leaf(doc)
            for left, right in steps:
                start = sha("".join([*left, start, *right]))
            proof = sha("".join("".join(a + b) for a, b in steps))
            out[(doc[0], leaf(doc), trees[lang][-1][0], above[-1][0], proof, start, start == above[-1][0])] += 1
    return out


def manifest_rows(n, seed=5):
    rng = random.Random(seed)
    langs = ["en", "en", "en", "de", "é", None, "", "zz"]
    rows = [
        (
            None if rng.random() < 0.05 else rng.randint(0, n // 2),
            rng.choice(["s", None, ""]),
            rng.choice(langs),
            rng.choice([None, 5, -3]),
            rng.choice([None, "", "ü 😀", "x" * 3000, "text"]),
        )
        for _ in range(n)
    ]
    return rows + rows[: n // 4] + [(1, None, "alone", 3, "only one")]


def documents(spark, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string, tree int, slot string, hash long, one int"
    return spark.createDataFrame([(*r, 1, "b", 2, 3) for r in rows], schema)


@pytest.mark.parametrize(("arity", "levels"), [(2, 10), (2, 2), (3, 2)])
def test_manifest_matches_brute_force(spark, arity, levels):
    rows = manifest_rows(90)
    got = merkle.manifest(documents(spark, rows), arity, levels)
    assert as_rows(got) == brute_manifest(rows, arity)


def test_manifest_of_few_rows(spark):
    assert merkle.manifest(documents(spark, []).limit(0)).collect() == []
    for rows in ([(3, "s", "en", 1, "a")], [(3, "s", "en", 1, "a")] * 3, [(0, None, None, None, None), (5, "s", "", 2, "y " * 400_000)]):
        assert as_rows(merkle.manifest(documents(spark, rows))) == brute_manifest(rows)


def test_only_tampered_rows_fail(spark):
    df = edge.documents(spark)
    for r in merkle.manifest(df.withColumn("n_chars", F.lit(4).cast("long"))).collect():
        assert r["verified"] == (r["doc_id"] is None or crc(r["doc_id"]) % 7 != 0)


# --- mixing ---------------------------------------------------------------------------------


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    keys = sorted(sizes, key=lambda k: (k is None, k or ""))
    w = {k: weights[i % 3] for i, k in enumerate(keys)}
    full = set()
    while True:
        rest = share * sum(sizes.values()) - most * sum(sizes[k] for k in full)
        open_weight = sum(w[k] for k in keys if k not in full)
        target = {k: most * sizes[k] if k in full else w[k] * rest / open_weight for k in keys}
        over = {k for k in keys if k not in full and target[k] > most * sizes[k]}
        if not over:
            return target
        full |= over


def mixed_rows(n=400, seed=3):
    rng = random.Random(seed)
    words = [" ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.choice([1, 3, 20, 60, 300]))) for _ in range(n)]
    rows = [(i, rng.choice(["hot", "hot", "a", "b", "é", None, ""]), w) for i, w in enumerate(words)]
    rows += [(10_000 + i, "hot", "the same text many times") for i in range(150)]
    rows += [(None, "a", None), (None, None, ""), (5, "small", "just three words"), (5, "small", "just three words")]
    return rows + rows[:20]


def mixable(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k") for r in rows], "doc_id long, source string, text string, size int, row long, key string")


def test_mix_meets_its_targets(spark):
    rows = mixed_rows()
    out = mixing.mix(mixable(spark, rows)).collect()
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((i, n_words(t)) for i, _, t in rows)
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += n_words(text)
    target = brute_targets(sizes)
    found = sorted((sizes[s], target[s]) for s in sizes)
    assert sorted({(r["source_size"], round(r["target"], 6)) for r in out}) == sorted({(s, round(t, 6)) for s, t in found})
    for size, aim in found:
        mine = [r for r in out if r["source_size"] == size]
        left = [r["size"] for r in mine if r["size"] and r["copies"] < r["expected"] - 1e-9]
        assert 0 <= int(aim + 0.5) - sum(r["taken"] for r in mine) < min(left, default=1)
    assert all(r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2 for r in out)


def test_mix_repeats_itself_whatever_the_partitions(spark):
    df = mixable(spark, mixed_rows())
    first = as_rows(mixing.mix(df))
    assert as_rows(mixing.mix(df.repartition(3, "size", "doc_id").orderBy("text"))) == first


def test_included_as_often_as_expected(spark):
    """Over many seeds a document is taken as often as its expected copies say."""
    rows = [(i, "s", f"text number{i}") for i in range(30)] + [(100 + i, "s", "same text") for i in range(10)]
    rows += [(200 + i, "t", f"other text{i}") for i in range(40)]
    df = stored(mixable(spark, rows))
    taken, expected, seeds = Counter(), {}, 25
    for seed in range(seeds):
        for r in mixing.mix(df, weights=(1, 3, 1), share=1.2, seed=seed).collect():
            taken[r["doc_id"]] += r["copies"]
            expected[r["doc_id"]] = r["expected"]
    single = sum(taken[i] for i in range(30)) / 30 / seeds
    copied = sum(taken[100 + i] for i in range(10)) / 10 / seeds
    assert abs(copied - expected[100]) < 0.1 < single - copied
    assert abs(single - expected[0]) < 0.1


def test_mix_of_nothing(spark):
    assert mixing.mix(mixable(spark, []).limit(0)).collect() == []
    out = mixing.mix(mixable(spark, [(1, "a", ""), (2, None, None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in out] == [(0, 0.0, 0)] * 2


def test_first_fit_in_order(spark):
    """Rounds over ranges take what one walk in order takes."""
    rng = random.Random(9)
    rows = [(i, rng.choice("xxxy"), rng.randint(1, 90), rng.random()) for i in range(300)]
    df = stored(spark.createDataFrame(rows, "row long, key string, size long, odds double"))
    room = stored(spark.createDataFrame([("x", 1500), ("y", 333)], "key string, words long"))
    got = {r["row"] for r in mixing.pick(df, room).collect()}
    left, want = {"x": 1500, "y": 333}, set()
    for row, key, size, _ in sorted(rows, key=lambda r: r[3]):
        if size <= left[key]:
            want.add(row)
            left[key] -= size
    assert got == want
