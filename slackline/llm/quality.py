"""Quality rules as a short-circuit cascade ordered by rejection per cost."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slackline.llm.common import SPACE, let, sampled, words

SYMBOLS = "#*$%&|<>"


def count_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def count_word_chars(text: Column) -> Column:
    bare = F.regexp_replace(text, SPACE + "+", "")
    return F.coalesce(F.length(bare), F.lit(0)).cast("long")


def count_symbols(text: Column) -> Column:
    bare = F.regexp_replace(text, r"[#*$%&|<>]+", "")
    return F.coalesce(F.length(text) - F.length(bare), F.lit(0)).cast("long")


def count_lines(text: Column) -> Column:
    """Lines with a word."""
    return F.coalesce(F.size(_lines(text)), F.lit(0)).cast("long")


def count_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    dup = let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return F.when(text.isNull(), F.lit(0)).otherwise(dup).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\f\r"))) > 0)


def count_repeat_words(text: Column, width: int = 5) -> Column:
    """Words in ``width``-word windows found twice or more in the text, the first included.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes, within one text.
    """
    return let(words(text), lambda w: repeat_words_of(w, width))


def repeat_words_of(found: Column, width: int = 5) -> Column:
    """``count_repeat_words`` of words."""

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - width),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]),
        )

    def covered(win: Column) -> Column:
        marked = F.sort_array(F.transform(win, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
        places = let(
            marked,
            lambda s: F.filter(
                s,
                lambda x, k: (x["w"] == F.get(s, k - 1)["w"]) | (x["w"] == F.get(s, k + 1)["w"]),
            )["i"],
        )
        start = F.struct(F.lit(-2 * width).alias("last"), F.lit(0).alias("total"))
        return F.aggregate(
            F.sort_array(places),
            start,
            lambda a, p: F.struct(
                p.alias("last"), (a["total"] + F.least(F.lit(width), p - a["last"])).alias("total")
            ),
            lambda a: a["total"],
        )

    def of_windows(win: Column) -> Column:
        return F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0)).otherwise(covered(win))

    hashes = F.transform(found, lambda x: F.xxhash64(x))
    repeats = let(hashes, lambda h: let(windows(h), of_windows))
    return F.when(F.size(found) <= width, F.lit(0)).otherwise(repeats).cast("long")


def count_shouted(text: Column) -> Column:
    """Upper-case letters less those that start a word, roughly: runs of two or more."""
    bare = F.regexp_replace(text, r"\p{Lu}{2,}", "")
    return F.coalesce(F.length(text) - F.length(bare), F.lit(0)).cast("long")


def count_letters(text: Column) -> Column:
    bare = F.regexp_replace(text, r"\p{L}+", "")
    return F.coalesce(F.length(text) - F.length(bare), F.lit(0)).cast("long")


def stutters_of(found: Column) -> Column:
    """Words equal to the word before them."""
    return F.size(F.filter(found, lambda x, i: (i > 0) & (x == F.get(found, i - 1)))).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects``: text column -> boolean column, never null. With ``of_words`` it takes the text's
    words as well; they are split once for all such rules."""

    name: str
    rejects: object
    of_words: bool = False

    def test(self, text: Column, found: Column | None) -> Column:
        return self.rejects(text, found) if self.of_words else self.rejects(text)


def default_rules(measured: dict[str, str] | None = None) -> list[Rule]:
    """The production rules. ``measured`` names columns that already hold a measure."""
    have = measured or {}

    def of(name: str, count):
        return lambda x: F.col(have[name]) if name in have else count(x)

    chars, symbols, dup = (
        of("word_chars", count_word_chars), of("n_symbols", count_symbols), of("n_dup_lines", count_dup_lines)
    )
    n_words = of("n_words", lambda w: F.size(w).cast("long"))
    repeat = of("n_repeat_words", repeat_words_of)

    def rule(name: str, rejects, *needs: str) -> Rule:
        """A rule of text and words; one whose measures of words are known needs no words."""
        if set(needs) <= set(have):
            return Rule(name, lambda t: rejects(t, None))
        return Rule(name, rejects, of_words=True)

    return [
        rule("few_words", lambda t, w: n_words(w) < 10, "n_words"),
        rule("repeated_windows", lambda t, w: 100 * repeat(w) > 20 * n_words(w), "n_words", "n_repeat_words"),
        rule("symbols", lambda t, w: 10 * symbols(t) > n_words(w), "n_words"),
        rule("repeated_lines", lambda t, w: (dup(t) >= 3) & (10 * dup(t) > 3 * count_lines(t))),
        rule("stutter", lambda t, w: 10 * stutters_of(w) > 3 * n_words(w), "n_words", "stutters"),
        rule("long_words", lambda t, w: chars(t) > 15 * n_words(w), "n_words"),
        rule("short_words", lambda t, w: chars(t) < 2 * n_words(w), "n_words"),
        rule("shouting", lambda t, w: 10 * count_shouted(t) > 3 * chars(t)),
        rule("no_prose", lambda t, w: 2 * count_letters(t) < chars(t)),
    ]


CLOCK = "CAST(java_method('java.lang.System', 'nanoTime') AS BIGINT)"


def order_rules(
    df: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = 2000, runs: int = 2
) -> list[tuple[Rule, float, float]]:
    """(rule, seconds per row, share rejected), most rejections per second first.

    The sample has about ``sample_rows`` rows. One job evaluates all rules on each of them, ``runs``
    times in turn, and reads the executor's clock in between; the shorter time of a row counts, so
    waiting for the cluster is no cost of a rule. Splitting the words is no rule's cost either. Only
    the order rests on all this, never a verdict.
    """
    sample = sampled(df.select(F.col(text).alias("text")), sample_rows)
    col, clock = F.col("text"), F.expr(CLOCK)

    def watched(found: Column) -> Column:
        fields = [clock.alias("t0")]
        for step in range(runs * len(rules)):
            rule = rules[step % len(rules)]
            fields += [rule.test(col, found).alias(f"r{step}"), clock.alias(f"t{step + 1}")]
        return F.struct(*fields)

    def took(place: int) -> Column:
        times = [F.col(f"m.t{s + 1}") - F.col(f"m.t{s}") for s in range(place, runs * len(rules), len(rules))]
        return times[0] if runs == 1 else F.least(*times)

    row = (
        sample.select(let(words(col), watched).alias("m"))
        .agg(
            F.count("*").alias("n"),
            *[F.sum(took(i)).alias(f"s{i}") for i in range(len(rules))],
            *[F.count_if(f"m.r{i}").alias(f"h{i}") for i in range(len(rules))],
        )
        .first()
    )
    if not row["n"]:
        return [(rule, 0.0, 0.0) for rule in rules]
    measured = [
        (rule, max(row[f"s{i}"], 1) / 1e9 / row["n"], row[f"h{i}"] / row["n"]) for i, rule in enumerate(rules)
    ]
    return sorted(measured, key=lambda r: (-r[2] / r[1], r[1], r[0].name))


def verdict(rules: list[Rule], text: Column) -> Column:
    """Name of the first rule that rejects, null if none does.

    A CASE: a rule is computed only for the rows that all rules before it let pass, and a
    text is split into words when the first rule that needs them is reached.
    """

    def chain(rest: list[Rule], found: Column | None) -> Column:
        out = F
        for place, rule in enumerate(rest):
            if rule.of_words and found is None:
                left = rest[place:]
                tail = let(words(text), lambda w: chain(left, w))
                return out.otherwise(tail) if place else tail
            out = out.when(rule.test(text, found), F.lit(rule.name))
        return out

    return chain(rules, None) if rules else F.lit(None).cast("string")


def with_verdict(
    df: DataFrame,
    text: str = "text",
    rules: list[Rule] | None = None,
    name: str = "rejected_by",
    sample_rows: int = 2000,
) -> DataFrame:
    """``df`` with the name of the rule that rejects a row, null for kept rows.

    Null, empty and blank texts have no words and are rejected by ``few_words``. Every row
    is judged alone, so repeated rows agree; a text is judged whole, however long. An empty table
    stays empty. All columns stay; a column called ``name`` is
    replaced.
    """
    rules = default_rules() if rules is None else rules
    ordered = [rule for rule, _, _ in order_rules(df, rules, text, sample_rows)]
    return df.withColumn(name, verdict(ordered, F.col(text)))


def keep_good(df: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """The rows no rule rejects, with the columns of ``df``."""
    rules = default_rules() if rules is None else rules
    ordered = [rule for rule, _, _ in order_rules(df, rules, text)]
    return df.where(verdict(ordered, F.col(text)).isNull())


def measures(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept): one row per row of ``df``. A null, empty or blank text has no words and fails.

    Rows are judged alone and whole, so repeated rows agree and a text of any length is measured to
    its end, in time that grows with its length (times its logarithm). An empty table gives no rows.
    """
    t = F.col("text")
    base = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id",
        "text",
        count_words(t).alias("n_words"),
        count_word_chars(t).alias("word_chars"),
        count_symbols(t).alias("n_symbols"),
        count_dup_lines(t).alias("n_dup_lines"),
        count_repeat_words(t).alias("n_repeat_words"),
    )
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    # The order is measured with every rule computing its own measure.
    order = [r.name for r, _, _ in order_rules(df, default_rules(), text)]
    rules = {r.name: r for r in default_rules({n: n for n in names})}
    passed = verdict([rules[n] for n in order], t).isNull()
    return base.select("doc_id", *names, failed.alias("base_failed"), (~failed & passed).alias("kept"))
