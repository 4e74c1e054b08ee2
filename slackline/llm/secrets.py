"""Secrets: a trigram index narrows each rule to candidate rows, which are then verified."""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slackline.llm.common import SPAN, found_spans, row_key, spans_text, stored

Query = list[frozenset[frozenset[str]]]

MANY = 48


@dataclass(frozen=True)
class Rule:
    """A pattern of one kind. ``least`` is the length ``group`` needs for a valid match.

    ``search``, where given, finds exactly the valid matches of ``pattern`` and no others: for
    a run of one class the least length can stand in the pattern itself.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    search: str = ""


def any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


KEYWORDS = any_case("password|passwd|secret|token|api_?key")

BASE = [
    Rule("assign", rf"({KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, r"AKIA[A-Z0-9]{14,}+"),
    Rule("hex", r"[0-9a-f]+", 0, 16, r"[0-9a-f]{16,}+"),
]

MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,251}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,250}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,250}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_password", r"://[A-Za-z0-9._%+-]{1,64}:[A-Za-z0-9._%+-]{3,64}@"),
]


def _trigrams(strings: set[str]) -> frozenset[frozenset[str]]:
    return frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


class _Reader:
    """Collects literals of one pattern. ``exact`` holds the strings the part read last can
    be; once they are too many or unknown, what they require becomes a clause."""

    def __init__(self) -> None:
        self.exact: set[str] = {""}
        self.clauses: Query = []

    def flush(self) -> None:
        clause = _trigrams(self.exact)
        if all(clause):
            self.clauses.append(clause)
        self.exact = {""}

    def cross(self, strings: set[str]) -> None:
        strings = {s.lower() for s in strings}
        if len(self.exact) * len(strings) > MANY:
            self.flush()
        self.exact = {a + b for a in self.exact for b in strings}

    def read(self, tree) -> None:
        for op, value in tree:
            if op is sre.LITERAL:
                self.cross({chr(value)})
            elif op is sre.IN and (chars := _small(value)):
                self.cross(chars)
            elif op is sre.SUBPATTERN:
                self.read(value[-1])
            elif op is sre.BRANCH:
                self.branch(value[1])
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
                self.repeat(*value)
            elif op not in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
                self.flush()

    def repeat(self, low, high, tree) -> None:
        inner = _Reader()
        inner.read(tree)
        if (low, high) == (0, 1) and not inner.clauses and len(inner.exact) <= 4 and inner.exact != {""}:
            self.cross(inner.exact | {""})
        elif low >= 1 and high == low and low <= 8:
            for _ in range(low):
                self.read(tree)
        elif low >= 1:
            self.read(tree)
            self.flush()
        else:
            self.flush()

    def branch(self, parts) -> None:
        readers = []
        for part in parts:
            reader = _Reader()
            reader.read(part)
            readers.append(reader)
        if not any(r.clauses for r in readers) and all(r.exact != {""} for r in readers):
            self.cross(set().union(*[r.exact for r in readers]))
            return
        self.flush()
        whole: set[frozenset[str]] = set()
        for reader in readers:
            reader.flush()
            if not reader.clauses:
                return
            # One clause per way keeps the query small; it asks for less, never for more.
            whole |= min(reader.clauses, key=len)
        self.clauses.append(frozenset(whole))


def _small(items) -> set[str]:
    """Characters of a class that has few after lower-casing, else none."""
    chars: set[str] = set()
    for op, value in items:
        if op is sre.LITERAL:
            chars.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < 8:
            chars.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return set()
    return chars if len(chars) <= 6 else set()


def trigram_query(pattern: str) -> Query:
    """Clauses that all must hold; a clause holds if all trigrams of one way are present.

    Trigrams are of the lower-cased text. No clause: the rule has no mandatory trigram.
    A pattern must not use inline flags.
    """
    reader = _Reader()
    reader.read(parser.parse(pattern))
    reader.flush()
    return reader.clauses


def build_index(df: DataFrame, rules: list[Rule], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings (trigram, key) of the trigrams that ``rules`` ask for, stored."""
    wanted = sorted({t for r in rules for clause in trigram_query(r.pattern) for way in clause for t in way})
    if not wanted:
        wanted = ["\x00\x00\x00"]
    rows = df.select(
        row_key(F.col(doc_id), F.col(text)).alias("key"), F.lower(F.col(text)).alias("low")
    ).where("low IS NOT NULL")
    grams = F.array(*[F.lit(t) for t in wanted])
    present = F.filter(grams, lambda t: F.contains(F.col("low"), t))
    return stored(rows.select(F.explode(present).alias("trigram"), "key"))


def candidates(postings: DataFrame, rules: list[Rule]) -> DataFrame:
    """(key, kinds): the rules whose trigram query holds for a row, by intersected postings.

    A row's postings meet under its key; there are at most as many as the rules have
    trigrams. Rules without a clause are in no list: they scan every row.
    """
    held = postings.groupBy("key").agg(F.collect_set("trigram").alias("held"))

    def holds(query: Query) -> Column:
        def way(trigrams: frozenset[str]) -> Column:
            need = F.array(*[F.lit(t) for t in sorted(trigrams)])
            return F.size(F.array_except(need, F.col("held"))) == 0

        all_clauses = F.lit(True)
        for clause in query:
            some = F.lit(False)
            for trigrams in sorted(clause, key=sorted):
                some = some | way(trigrams)
            all_clauses = all_clauses & some
        return all_clauses

    kinds = [
        F.when(holds(query), F.lit(rule.kind))
        for rule in rules
        if (query := trigram_query(rule.pattern))
    ]
    if not kinds:
        kinds = [F.lit(None).cast("string")]
    found = held.select("key", F.array_compact(F.array(*kinds)).alias("kinds"))
    return found.where(F.size("kinds") > 0)


def verified(rule: Rule, text: Column, kinds: Column) -> Column:
    """Valid spans of ``rule``, searched only if it is among ``kinds`` or scans fully."""
    spans = found_spans(text, rule.kind, rule.search or rule.pattern)
    if rule.group:
        spans = F.filter(
            spans,
            lambda s: F.length(F.regexp_extract(s["found"], rule.pattern, rule.group)) >= rule.least,
        )
    elif rule.least > 1 and not rule.search:
        spans = F.filter(spans, lambda s: F.length(s["found"]) >= rule.least)
    if not trigram_query(rule.pattern):
        return spans
    none = F.array().cast(f"array<{SPAN}>")
    return F.when(F.array_contains(kinds, rule.kind), spans).otherwise(none)


def scan(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", base: list[Rule] | None = None,
    more: list[Rule] | None = None,
) -> DataFrame:
    """(doc_id, text, base, spans): one row per row of ``df``.

    ``base`` holds the spans of the base rules, ``spans`` those of all rules, by start, then
    kind as listed; ends are exclusive, positions code points. Null and empty texts have
    none. Repeated rows share their postings and get equal spans.
    """
    base = BASE if base is None else base
    more = MORE if more is None else more
    rules = [*base, *more]
    found = candidates(build_index(df, rules, doc_id, text), rules)
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    joined = rows.join(found, "key", "left").withColumn(
        "kinds", F.coalesce("kinds", F.array().cast("array<string>"))
    )
    order = {rule.kind: i for i, rule in enumerate(rules)}

    def by_start(spans: Column) -> Column:
        place = F.array(*[F.lit(k) for k in order])
        keyed = F.transform(
            spans,
            lambda s: F.struct(s["start"].alias("at"), F.array_position(place, s["kind"]).alias("k"), s.alias("span")),
        )
        return F.transform(F.sort_array(keyed), lambda x: x["span"])

    def all_of(part: list[Rule]) -> Column:
        none = F.array().cast(f"array<{SPAN}>")
        return F.concat(none, *[verified(r, F.col("text"), F.col("kinds")) for r in part])

    spans = joined.select("doc_id", "text", all_of(base).alias("base"), all_of(more).alias("more"))
    return spans.select(
        "doc_id", "text", by_start(F.col("base")).alias("base"),
        by_start(F.concat("base", "more")).alias("spans"),
    )


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def digest_rows(df: DataFrame) -> DataFrame:
    """The contract's columns, one row per row of ``df``."""
    found = scan(df)
    counts = [
        F.size(F.filter("base", _of_kind(rule.kind))).cast("long").alias(f"n_{rule.kind}") for rule in BASE
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def oracle() -> str:
    """DuckDB SQL for ``digest_rows`` of ``documents``, by scanning every row for every rule."""
    rules = [*BASE, *MORE]
    quoted = lambda s: s.replace("'", "''")
    parts = []
    for place, rule in enumerate(rules):
        size = f"length(regexp_extract(m, '{quoted(rule.pattern)}', {rule.group}))"
        parts.append(
            f"""SELECT rid, {place} AS place, '{rule.kind}' AS kind, m,
            list_sum(list_transform(p[1:i], lambda x: length(x))) +
            coalesce(list_sum(list_transform(a[1:i-1], lambda x: length(x))), 0) AS begins
            FROM (SELECT rid, p, a, unnest(a) AS m, unnest(range(1, len(a) + 1)) AS i FROM (
              SELECT rid, string_split_regex(text, '{quoted(rule.pattern)}') AS p,
              regexp_extract_all(text, '{quoted(rule.pattern)}') AS a FROM docs))
            WHERE {size} >= {rule.least}"""
        )
    spans = " UNION ALL ".join(parts)
    joined = "string_agg(kind || ':' || CAST(begins AS BIGINT) || ':' || CAST(begins + length(m) AS BIGINT), ',' ORDER BY begins, place)"
    base = f"{joined} FILTER (WHERE place < {len(BASE)})"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    outer = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)
    return f"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    spans AS ({spans}),
    found AS (SELECT rid, {counts}, {base} AS base, {joined} AS spans FROM spans GROUP BY rid)
    SELECT doc_id, {outer}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM docs LEFT JOIN found USING (rid)"""
