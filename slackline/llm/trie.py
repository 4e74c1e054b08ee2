"""The prefix trie of conversations as a z-fast trie.

A path is a row per turn with a key of all turns so far. A compacted node is a row (extent key
and depth, parent, name key, handle key); its handle is the prefix at the two-fattest depth of
its edge. A new conversation finds where it leaves the trie by fat binary search over handles,
so only its turns from there on are grouped into new nodes, together with the edges they split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slackline.functions.joins import lookup_join
from slackline.llm.common import running, stored, word_count

HEAD = 4
BASE = 20
BLOCK = 4096
#: Shares of the conversations, in 64ths, that are in the trie after each batch.
BATCHES = (1, 8, 64)
KEY = ["hi", "lo"]


def rebuilt(df: DataFrame, head: int = HEAD, base: int = BASE, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(path, sizes) of all rebuilt conversations, both stored.

    ``path`` (conv, pos from 1, hi, lo, up_hi, up_lo, words, before, ends): the key (hi, lo) of
    the first ``pos`` turns, that of one turn less, the words of this turn and of all turns
    before it, and whether it is the last. A key is the bitwise sum of two 64-bit hashes of every
    (pos, MD5 of role and text), so a running sum in blocks gives the keys of a conversation of
    any length. ``sizes`` (conv, len) has the turnless ones too.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = stored(
        df.where("conv_id IS NOT NULL").select(
            F.col("conv_id").cast("long").alias("conv"),
            "turn",
            F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("said"),
            word_count(text).alias("words"),
            F.lit(1).cast("long").alias("one"),
        )
    )
    own = stored(running(turns, ["conv"], ["turn", "said"], {"place": "one"}).withColumn("place", F.col("place") + 1))
    heads = (
        own.where(f"conv % {base} = 0 AND place < {head}")
        .groupBy(F.col("conv").alias("first"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "said", "words"))).alias("begin"))
    )
    skip = F.crc32(F.col("conv").cast("string").cast("binary")) % head
    sizes = (
        own.groupBy("conv")
        .agg(F.count("*").alias("turns"))
        .withColumn("skip", skip)
        .withColumn("first", F.col("conv") - F.col("conv") % base)
    )
    sizes = lookup_join(sizes, heads, ["first"], "left")
    none = F.array().cast("array<struct<place:long,said:binary,words:long>>")
    begin = F.slice(F.coalesce("begin", none), F.lit(1), F.col("skip").cast("int"))
    sizes = sizes.withColumn("begin", begin).withColumn("shift", F.size("begin") - F.col("skip"))
    sizes = stored(
        sizes.withColumn("len", F.size("begin") + F.greatest(F.lit(0), F.col("turns") - F.col("skip")))
    )
    kept = lookup_join(own, sizes.select("conv", "skip", "shift", "len"), ["conv"]).where("place > skip")
    rows = kept.select("conv", (F.col("place") + F.col("shift")).alias("pos"), "said", "words", "len").union(
        sizes.select("conv", "len", F.explode("begin").alias("b")).select("conv", "b.place", "b.said", "b.words", "len")
    )
    rows = stored(
        rows.select(
            "conv", "pos", "words", "len", (F.col("pos") == F.col("len")).alias("ends"), F.expr(f"pos div {block}").alias("block"),
            F.xxhash64("pos", "said").alias("own_hi"), F.xxhash64("said", "pos", F.lit(1)).alias("own_lo"),
        )
    )
    names = {"hi": F.bit_xor("own_hi"), "lo": F.bit_xor("own_lo"), "sum": F.sum("words")}
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    over = {"hi": F.bit_xor("_hi"), "lo": F.bit_xor("_lo"), "sum": F.sum("_sum")}
    carried = (
        rows.where(f"len >= {block}")
        .groupBy("conv", "block")
        .agg(*[value.alias(f"_{n}") for n, value in names.items()])
        .select("conv", "block", *[value.over(earlier).alias(f"_from_{n}") for n, value in over.items()])
        .where("_from_sum IS NOT NULL")
    )
    inside = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    here = rows.select("*", *[value.over(inside).alias(f"_{n}") for n, value in names.items()])
    here = lookup_join(here, stored(carried), ["conv", "block"], "left")
    zero = F.lit(0).cast("long")
    key = {n: F.col(f"_{n}").bitwiseXOR(F.coalesce(f"_from_{n}", zero)) for n in KEY}
    path = here.select(
        "conv", "pos", key["hi"].alias("hi"), key["lo"].alias("lo"),
        key["hi"].bitwiseXOR(F.col("own_hi")).alias("up_hi"), key["lo"].bitwiseXOR(F.col("own_lo")).alias("up_lo"),
        "words", (F.col("_sum") + F.coalesce("_from_sum", zero) - F.col("words")).alias("before"), "ends",
    )
    return stored(path), sizes.select("conv", "len")


def two_fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    bits = f"(length(bin({low} ^ {high})) - 1)"
    return F.expr(f"shiftleft(shiftright({high}, {bits}), {bits})")


def _probed(frame: DataFrame, path: DataFrame, depth: str, names: list[str]) -> DataFrame:
    """``frame`` with the key of its ``conv`` at ``depth``; null where there is none."""
    keys = path.select("conv", F.col("pos").alias(depth), *[F.col(k).alias(n) for k, n in zip(KEY, names, strict=True)])
    return frame.join(keys, ["conv", depth], "left")


def _with_keys(nodes: DataFrame, path: DataFrame) -> DataFrame:
    """``nodes`` (hi, lo, depth, up_hi, up_lo, up_depth, conv) with the keys of name and handle."""
    nodes = nodes.withColumn("name_depth", F.col("up_depth") + 1).withColumn("handle", two_fattest("up_depth", "depth"))
    nodes = _probed(nodes, path, "name_depth", ["name_hi", "name_lo"])
    return _probed(nodes, path, "handle", ["handle_hi", "handle_lo"]).drop("name_depth", "handle")


def _located(new: DataFrame, path: DataFrame, trie: DataFrame, rounds: int) -> DataFrame:
    """(conv, from_hi, from_lo, from_depth): the deepest node whose extent each of ``new`` begins with.

    Fat binary search: the prefix at the two-fattest depth of what is open is looked up among
    the handles. A hit moves the search beyond that node's extent, a miss below the depth. A
    conversation that left the trie inside the last node hit goes on from that node's parent.
    """
    node = ["hi", "lo", "depth", "up_hi", "up_lo", "up_depth"]
    handles = trie.where("depth > 0").select(
        F.col("handle_hi").alias("probe_hi"), F.col("handle_lo").alias("probe_lo"), F.struct(*node).alias("hit")
    )
    zero = F.lit(0).cast("long")
    root = F.struct(*[zero.alias(n) for n in node])
    state = new.select("conv", "len", zero.alias("low"), F.col("len").alias("high"), root.alias("last"))
    for _ in range(rounds):
        state = state.withColumn("at", F.when(F.col("low") < F.col("high"), two_fattest("low", "high")))
        state = _probed(state, path, "at", ["probe_hi", "probe_lo"])
        # Closed searches look for a key that no handle has, each its own, not all for null.
        state = state.withColumns({"probe_hi": F.coalesce("probe_hi", "conv"), "probe_lo": F.coalesce("probe_lo", "conv")})
        state = lookup_join(state, handles, ["probe_hi", "probe_lo"], "left")
        found, asked = F.col("hit").isNotNull(), F.col("at").isNotNull()
        state = state.select(
            "conv", "len",
            F.when(found, F.col("hit.depth")).otherwise(F.col("low")).alias("low"),
            F.when(asked & ~found, F.col("at") - 1).otherwise(F.col("high")).alias("high"),
            F.when(found, F.col("hit")).otherwise(F.col("last")).alias("last"),
        )
    state = _probed(state.withColumn("at", F.col("last.depth")), path, "at", ["x_hi", "x_lo"])
    whole = (F.col("at") == 0) | ((F.col("x_hi") == F.col("last.hi")) & (F.col("x_lo") == F.col("last.lo")))
    inside = F.coalesce(whole, F.lit(False))
    return state.select(
        "conv",
        *[F.when(inside, F.col(f"last.{n}")).otherwise(F.col(f"last.up_{n}")).alias(f"from_{n}") for n in ("hi", "lo", "depth")],
    )


def _edge_rows(edges: DataFrame, path: DataFrame, block: int = BLOCK) -> DataFrame:
    """``edges`` expanded: the path rows of ``conv`` at the depths (up_depth, depth] of each."""
    blocks = edges.withColumn("_b", F.explode(F.expr(f"sequence((up_depth + 1) div {block}, depth div {block})")))
    low = F.greatest(F.col("up_depth") + 1, F.col("_b") * block)
    high = F.least(F.col("depth"), F.col("_b") * block + block - 1)
    return blocks.withColumn("pos", F.explode(F.sequence(low, high))).drop("_b").join(path, ["conv", "pos"])


def _nearest(rows: DataFrame, value: Column, block: int = BLOCK) -> DataFrame:
    """``rows`` (conv, pos, …) with ``near``: the last non-null ``value`` before each row of its conv."""
    cut = rows.withColumn("_value", value).withColumn("_block", F.expr(f"pos div {block}"))
    late = F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("pos")))
    earlier = Window.partitionBy("conv").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = cut.groupBy("conv", "_block").agg(late.alias("_late"))
    carried = blocks.withColumn("_from", F.last("_late", ignorenulls=True).over(earlier)).drop("_late")
    inside = Window.partitionBy("conv", "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    here = cut.withColumn("_in", F.last("_value", ignorenulls=True).over(inside))
    both = here.join(carried.where("_from IS NOT NULL"), ["conv", "_block"], "left")
    return both.withColumn("near", F.coalesce("_in", "_from")).drop("_value", "_block", "_in", "_from")


def _inserted(new: DataFrame, path: DataFrame, trie: DataFrame, rounds: int, empty: bool, block: int = BLOCK) -> DataFrame:
    """``trie`` with the conversations ``new`` (conv, len > 0)."""
    zero = F.lit(0).cast("long")
    if empty:
        found = new.select("conv", *[zero.alias(f"from_{n}") for n in ("hi", "lo", "depth")])
    else:
        found = _located(new, path, trie, rounds)
    found = stored(found)
    ahead = path.join(found, "conv").where("pos > from_depth")
    ahead = stored(ahead.withColumn("old", F.lit(False)))
    steps = ahead.where("pos = from_depth + 1").select(F.col("hi").alias("name_hi"), F.col("lo").alias("name_lo")).distinct()
    split = stored(trie.where("depth > 0").join(stored(steps), ["name_hi", "name_lo"], "left_semi"))
    start = [F.col(f"up_{n}").alias(f"from_{n}") for n in ("hi", "lo", "depth")]
    # A stored edge is expanded for its turns; its lower end stays a node, and so does its origin.
    edges = split.select("conv", "depth", "up_depth", *start)
    edges = _edge_rows(edges, path, block).withColumn("old", F.col("pos") == F.col("depth"))
    rows = stored(ahead.unionByName(edges.select(*ahead.columns).withColumn("ends", F.lit(False))))
    turns = stored(
        rows.groupBy(*KEY, "up_hi", "up_lo").agg(
            F.min("conv").alias("member"), F.max(F.col("ends") | F.col("old")).alias("stays")
        )
    )
    children = turns.groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(F.count("*").alias("n"))
    nodes = turns.join(children, KEY, "left").where("stays OR n > 1").select(*KEY, "member")
    marked = lookup_join(rows, stored(nodes), KEY, "left")
    here = F.when(F.col("member").isNotNull(), F.struct(*KEY, F.col("pos").alias("depth")))
    near = _nearest(marked, here, block).where("member = conv")
    begin = F.struct(*[F.col(f"from_{n}").alias(n) for n in ("hi", "lo", "depth")])
    near = near.withColumn("up", F.when(F.col("near.depth") > F.col("from_depth"), F.col("near")).otherwise(begin))
    made = near.select(
        *KEY, F.col("pos").alias("depth"), F.col("up.hi").alias("up_hi"), F.col("up.lo").alias("up_lo"),
        F.col("up.depth").alias("up_depth"), "conv",
    )
    kept = trie.join(split.select(*KEY), KEY, "left_anti")
    return stored(kept.unionByName(_with_keys(made, path)))


def built(path: DataFrame, strings: DataFrame, batches=BATCHES, block: int = BLOCK) -> DataFrame:
    """The compacted nodes of all ``strings`` (conv, len), the root among them."""
    zero = F.lit(0).cast("long")
    names = ["hi", "lo", "depth", "up_hi", "up_lo", "up_depth", "conv", "name_hi", "name_lo", "handle_hi", "handle_lo"]
    trie = stored(path.sparkSession.range(1).select(*[(F.lit(-1).cast("long") if n == "up_depth" else zero).alias(n) for n in names]))
    dealt = strings.where("len > 0").withColumn("_part", F.pmod(F.xxhash64("conv"), F.lit(64)))
    longest = strings.agg(F.max("len")).first()[0] or 0
    before, empty = 0, True
    for until in batches:
        new = dealt.where(f"_part >= {before} AND _part < {until}").drop("_part")
        before = until
        if new.isEmpty():
            continue
        trie = _inserted(new, path, trie, int(longest).bit_length() + 1, empty, block)
        empty = False
    return trie


def _ends(members: DataFrame, chunk: int = 4096) -> DataFrame:
    """(hi, lo, ends_sha256): SHA-256 of the ascending ids of ``members`` (conv, hi, lo), comma-joined.

    Ids are joined in pieces of ``chunk``; a task then reads the pieces of a key in order and
    holds one at a time.
    """
    numbered = running(stored(members.withColumn("one", F.lit(1).cast("long"))), KEY, ["conv"], {"place": "one"})
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = numbered.groupBy(*KEY, F.expr(f"place div {chunk}").alias("piece")).agg(ids.alias("ids"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for pdf in batches:
            out = []
            for hi, lo, ids in zip(pdf["hi"].tolist(), pdf["lo"].tolist(), pdf["ids"], strict=True):
                if (hi, lo) != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (hi, lo), hashlib.sha256()
                    state.update(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, state.hexdigest())], columns=[*KEY, "ends_sha256"])

    sorted_pieces = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece")
    return sorted_pieces.mapInPandas(hashed, "hi long, lo long, ends_sha256 string")


def prefix_trie(
    df: DataFrame, head: int = HEAD, base: int = BASE, batches=BATCHES, block: int = BLOCK
) -> DataFrame:
    """A row per distinct beginning of the rebuilt conversations of ``df`` (conv_id, turn, role, text).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).
    Turns go by ``turn``, null first, equal ones by the MD5 of role and text; null role or text
    is empty, and empty ones are turns like others. Rows without conv_id belong to no
    conversation. A repeated row is a further turn. Texts of any length are hashed where they
    are read. Other columns are ignored. An empty table gives no row, others a root at least.

    Equal conversations enter the trie once, with their number. A node's counts are sums over
    the different conversations through it: their copies, their words, and the words they were
    the first to say, which are counted once. An edge is one row until the end.
    """
    path, sizes = rebuilt(df, head, base, block)
    if sizes.isEmpty():
        zero = F.lit(0).cast("long")
        return sizes.select(
            F.col("conv").alias("conv_id"), *[zero.alias(n) for n in ("depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.lit("").alias("ends_sha256"),
        )
    zero = F.lit(0).cast("long")
    last = path.where("ends").select(*KEY, "conv", F.col("pos").alias("len"), (F.col("before") + F.col("words")).alias("all_words"))
    none = sizes.where("len = 0").select(zero.alias("hi"), zero.alias("lo"), "conv", zero.alias("len"), zero.alias("all_words"))
    members = stored(last.union(none))
    strings = stored(
        members.groupBy(*KEY).agg(
            F.min("conv").alias("conv"), F.count("*").alias("n"), F.max("len").alias("len"), F.max("all_words").alias("all_words")
        )
    )
    mine = stored(lookup_join(path, strings.select("conv"), ["conv"], "left_semi"))
    trie = built(mine, strings.select("conv", "len"), batches, block)
    # Every different conversation with every node on its way.
    nodes = trie.select(*KEY, "depth")
    through = lookup_join(mine.select(*KEY, "conv", F.col("before") + F.col("words").alias("said")), nodes, KEY)
    through = through.toDF(*KEY, "conv", "said", "depth").union(
        strings.select(zero.alias("hi"), zero.alias("lo"), "conv", zero.alias("said"), zero.alias("depth"))
    )
    through = stored(through)
    least = stored(through.groupBy(*KEY).agg(F.min("conv").alias("member")))
    # Words that a conversation is the first to say lie below the last node it shares with a smaller one.
    shared = lookup_join(through, least, KEY).where("member < conv").groupBy("conv").agg(F.max("said").alias("shared"))
    parents = trie.where("depth > 0").groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(F.count("*").alias("n_children"))
    parents = stored(parents)
    own = strings.join(shared, "conv", "left").join(parents, KEY, "left").select(
        "conv", "n", "all_words", (F.col("all_words") - F.coalesce("shared", zero)).alias("own"),
        F.col("n_children").isNull().cast("long").alias("leaf"),
    )
    own = stored(own)
    sums = lookup_join(through, own, ["conv"]).groupBy(*KEY).agg(
        F.min(F.struct("conv", "own", "all_words")).alias("least"), F.sum("n").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"), F.sum(F.col("n") * F.col("all_words") - F.col("own")).alias("repeated"),
    )
    whole = F.col("repeated") + F.col("least.own") - F.col("least.all_words")
    counted = trie.select(*KEY, "depth", "up_hi", "up_lo", "up_depth").join(sums, KEY).join(parents, KEY, "left").select(
        *KEY, "depth", "up_hi", "up_lo", "up_depth", F.col("least.conv").alias("conv"), "n_convs", "n_leaves",
        F.coalesce("n_children", zero).alias("n_children"), whole.alias("whole"),
    )
    counted = stored(counted.join(_ends(members.select("conv", *KEY)), KEY, "left"))
    above = counted.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv").alias("up_conv"))
    edges = lookup_join(counted.where("depth > 0").drop("hi", "lo"), above, ["up_hi", "up_lo"], "left").drop("up_hi", "up_lo")
    grown = _edge_rows(edges, mine.select("conv", "pos", "before"), block)
    bottom, top = F.col("pos") == F.col("depth"), F.col("pos") == F.col("up_depth") + 1
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    below = grown.select(
        F.col("conv").alias("conv_id"), F.col("pos").alias("depth"),
        F.when(top, F.col("up_conv")).otherwise(F.col("conv")).alias("parent_conv_id"), "n_convs",
        F.when(bottom, F.col("n_children")).otherwise(1).alias("n_children"), "n_leaves",
        (F.col("whole") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
        F.when(bottom, F.coalesce("ends_sha256", nothing)).otherwise(nothing).alias("ends_sha256"),
    )
    root = counted.where("depth = 0").select(
        F.col("conv").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", F.col("whole").alias("saved_tokens"),
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
    return below.union(root)
