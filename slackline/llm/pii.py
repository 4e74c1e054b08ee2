"""Personal data: base patterns, and loose candidates that prove themselves or that boosted trees select."""

from __future__ import annotations

import math
import random
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slackline.llm.common import SPAN, chunks, earlier_max, found_spans, let, piece, spans_text, stored

KINDS = ["email", "ip", "card", "phone"]

# Possessive repeats and the look-behind only spare the matcher useless starts: a run of the
# first class either matches from its first character on or not at all.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: Characters of an account number by country, in both letters of the country code.
IBAN = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC",
}


def _iban() -> str:
    def groups(size: int) -> str:
        whole, rest = divmod(size - 4, 4)
        return rf"(?:\x20?[A-Z0-9]{{4}}){{{whole}}}" + (rf"\x20?[A-Z0-9]{{{rest}}}" if rest else "")

    known = "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}{groups(n)}" for n, c in IBAN.items())
    return rf"\b(?:(?:{known})\b|[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{3,7}}\b)"


# Generators of candidates: wide on purpose, and free to overlap.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++"
    r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
    "number": r"(?<![0-9])[+(]?[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+",
    "account": _iban(),
}


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True if a short string of digits passes the check; false for other lengths than 13-19."""

    def total(n: Column) -> Column:
        def worth(i: Column) -> Column:
            d = F.substring(n, F.length(n) - i, F.lit(1)).cast("int")
            twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
            return F.when(i % 2 == 0, d).otherwise(twice)

        places = F.transform(F.sequence(F.lit(0), F.length(n) - 1), worth)
        return F.aggregate(places, F.lit(0), lambda a, x: a + x)

    fits = F.length(number).between(13, 19)
    return F.when(fits, let(number, lambda n: total(n) % 10 == 0)).otherwise(F.lit(False))


def _valid(kind: str, span: Column) -> Column:
    found = span["found"]
    if kind == "ip":
        parts = F.split(found, r"\.")
        short = F.transform(parts, lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(short, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= F.lit("255")))
    if kind == "card":
        return luhn(digits(found))
    if kind == "phone":
        return F.length(digits(found)).between(9, 15)
    return F.lit(True)


def _validity(kind: str):
    return lambda span: _valid(kind, span)


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def base_spans(text: Column) -> Column:
    """Valid base matches by kind as listed, then start."""
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    found = [
        F.filter(found_spans(text, kind, patterns[kind]), _validity(kind)) for kind in KINDS
    ]
    return F.concat(*found)


def candidates(text: Column) -> Column:
    return F.concat(*[found_spans(text, kind, pattern) for kind, pattern in LOOSE.items()])


PLAN = r"^(?:00[1-9]|\(?0[1-9]|(?:1[\x20.-]{0,2})?\(?[2-9][0-9]{2}[\x20().-]{1,2}[2-9][0-9]{2}[\x20.-][0-9]{4}$)"
DATE = r"^(?:[0-9]{1,2}[.-][0-9]{1,2}[.-][0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})"
PHONE_WORD = (
    r"(?:^|[^\p{L}])(?:tel|telephone|telefon|telefono|teléfono|téléphone|phone|fon|call|mobile|mobil|móvil|cell|handy|fax"
    r"|whatsapp|sms|ring|anruf|appel\w*|llam\w+)(?:[\x20-]?(?:number|nummer|no|nr))?[^\p{L}\p{N}]*$"
)
CARD_GROUPS = r"^(?:[0-9]{4}(?:[\x20.-]{1,2}[0-9]{4}){3}|3[47][0-9]{2}[\x20.-]{1,2}[0-9]{6}[\x20.-]{1,2}[0-9]{5}|[0-9\x20-]+)$"
TOP = r"(?i)(?:\.|\(dot\)|\[dot\])\x20?(?:[a-z]{2}|com|org|net|edu|gov|mil|int|info|biz|name|app|dev|cloud|online|shop)$"


def mod97(account: Column) -> Column:
    """True if an account number without blanks passes the check of ISO 13616."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def step(a: Column, c: Column) -> Column:
        value = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        return (a * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


def evidence(text: Column, span: Column) -> Column:
    """True if a candidate proves itself, whatever the base patterns say of it.

    An email by its marks and top-level domain; an ip by its octets; an account by its country's
    length and mod 97; a number by Luhn and the grouping of cards, by a plus and 9 to 15 digits,
    or by a national number plan after a word such as ``tel``.
    """
    found = span["found"]
    plain = F.regexp_replace(found, r"\x20", "")
    sizes = "^(?:" + "|".join(f"(?:{c.replace(' ', '|')}).{{{n - 2}}}" for n, c in IBAN.items()) + ")$"
    before = F.lower(F.substring(text, F.greatest(span["start"] - 29, F.lit(1)), F.least(span["start"], F.lit(30))))
    size = F.length(digits(found))
    card = found.rlike(CARD_GROUPS) & luhn(digits(found))
    abroad = found.startswith("+") & size.between(9, 15)
    national = size.between(8, 15) & found.rlike(PLAN) & ~found.rlike(DATE) & before.rlike(PHONE_WORD)
    octets = F.forall(F.split(found, r"\."), lambda p: ~p.rlike("^0[0-9]") & (p.cast("int") <= 255))
    return (
        F.when(span["kind"] == "email", found.rlike(TOP) & ~found.rlike(r"\x20@|@\x20"))
        .when(span["kind"] == "ip", octets)
        .when(span["kind"] == "account", plain.rlike(sizes) & mod97(plain))
        .otherwise(card | abroad | national)
    )


#: Words before a span that speak of reaching somebody, and of a thing that has a number.
CONTACT = (
    r"(?:^|[^\p{L}])(?:reach|contact|dial|number|write|mail|e-mail|message|ask|hotline|desk|home|office|doctor|erreichbar|kontakt"
    r"|nummer|schreib\w*|joindre|contacter|numéro|écri\w+|contacto|número|escrib\w+)(?:[^\p{L}]+\p{L}{1,6}){0,2}[^\p{L}\p{N}]*$"
)
REFERENCE = (
    r"(?:^|[^\p{L}])(?:order|invoice|part|item|ref|reference|version|build|release|id|isbn|serial|lot|batch|ticket|case|page|line"
    r"|total|sum|price|bestell\w*|rechnung|artikel|commande|facture|pedido|factura|commit|hash|key|token|v)"
    r"(?:[^\p{L}]+(?:no|nr|number|nummer|is))?[^\p{L}\p{N}]*$"
)

#: What the trees see: format and context. The labels do not come from any of it.
FEATURES = [
    "email", "ip", "number", "length", "digits", "letters", "blanks", "dots", "dashes", "brackets", "groups",
    "issuer", "plan", "date", "sign", "lopsided", "spelled", "last", "contact", "reference", "free_left", "free_right",
]


def features(text: Column, span: Column) -> dict[str, Column]:
    """Format of the span, its edges and the words before it, and its ``evidence``, as doubles."""
    found = span["found"]
    start, end = span["start"], span["end"]

    def count(chars: str) -> Column:
        return F.length(found) - F.length(F.regexp_replace(found, chars, ""))

    left = F.when(start == 0, F.lit(" ")).otherwise(F.substring(text, start, F.lit(1)))
    right = F.substring(text, end + 1, F.lit(1))
    before = F.lower(F.substring(text, F.greatest(start - 29, F.lit(1)), F.least(start, F.lit(30))))
    values = {
        "email": span["kind"] == "email",
        "ip": span["kind"] == "ip",
        "number": span["kind"] == "number",
        "length": F.length(found),
        "digits": count("[0-9]+"),
        "letters": count("[A-Za-z]+"),
        "blanks": count(r"\x20+"),
        "dots": count(r"\.+"),
        "dashes": count("-+"),
        "brackets": count(r"[()\[\]]+"),
        "groups": F.regexp_count(found, F.lit("[A-Za-z0-9]+")),
        "issuer": found.rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|6)"),
        "plan": found.rlike(PLAN),
        "date": found.rlike(DATE),
        "sign": found.contains("@"),
        "lopsided": found.rlike(r"\x20@[^\x20]|[^\x20]@\x20"),
        "spelled": found.rlike(r"[\[(](?:at|dot)[\])]"),
        "last": F.length(F.regexp_extract(found, "([A-Za-z]*)$", 1)),
        "contact": before.rlike(CONTACT),
        "reference": before.rlike(REFERENCE),
        "free_left": left.rlike(r"[^\p{L}\p{N}]"),
        "free_right": (right == "") | right.rlike(r"[^\p{L}\p{N}]"),
        "evidence": evidence(text, span),
    }
    return {name: values[name].cast("double") for name in [*FEATURES, "evidence"]}


# Sentences that the trees learn from, next to the candidates of the documents: {} is the span, # a
# digit, ~ a word. The first are personal data in forms that prove nothing, the others are not.
PERSONAL = {
    "number": (
        ["(###) ###-####", "###-###-####", "###.###.####", "0## #######", "0# ## ## ## ##", "0####-######", "### ### ###", "###-####"],
        ["reach me at {}", "my number is {}", "contact ~ on {}", "dial {} now", "ask for ~ at {}", "home {}", "erreichbar unter {}",
         "meine nummer ist {}", "me joindre au {}", "mon numéro est le {}", "mi número es {}", "contacto: {}"],
    ),
    "email": (
        ["~.~ @ ~.com", "~ @ ~-~.org", "~.~ [at] ~ [dot] studio", "~(at)~(dot)museum", "~## @ mail . ~ . net", "~_~ [at] ~.travel"],
        ["reach me at {}", "write to {}", "contact {} for more", "mail: {}", "{} is my address", "schreib an {}", "écrivez à {}", "~ ~ {}",
         "escribe a {}"],
    ),
}
OTHER = {
    "number": (
        ["#######", "####-######", "0## #######", "978-#-##-######-#", "20##-0#-1#", "0#.1#.20##", "############", "#### #### #### ####",
         "################", "#.###.###.###", "###-###-####", "(##) ########", "# ### ###", "##-##-####"],
        ["order {} came", "invoice no {} of ~", "part {}", "version {}", "ref {}", "isbn {}", "~ {} ~", "total {}", "id: {}", "token ~#{}",
         "~, {} ~", "bestellung {}", "facture {}", "pedido {}", "call on {}", "hash {}", "from {} to"],
    ),
    "email": (
        ["~ @~.~", "# @ #.##", "~ @ ~.~~~~", "~ @~-~.##", "~# @ #.#.#"],
        ["use {} there", "{} each", "import {}", "meet {} later", "~ {} ~", "version {}", "price {}", "tag {}"],
    ),
}


def examples(count: int, seed: int) -> list[tuple[str, float]]:
    """``count`` (sentence, 1.0 for personal data or 0.0) of the patterns above, the same for the same seed."""
    source = random.Random(seed)

    def filled(m: re.Match) -> str:
        if m[0] == "#":
            return str(source.randint(0, 9))
        return "".join(source.choice("bcdfglmnprst") + source.choice("aeiou") for _ in range(source.randint(1, 4)))

    out = []
    for i in range(count):
        spans, sentences = source.choice(list((PERSONAL, OTHER)[i % 2].values()))
        sentence = source.choice(sentences).replace("{}", source.choice(spans))
        out.append((re.sub("[#~]", filled, sentence), 1.0 - i % 2))
    return out


@dataclass
class Selector:
    """Trees as (feature, threshold, low, high) or a leaf value, their weights, thresholds."""

    trees: list = field(default_factory=list)
    weights: list = field(default_factory=list)
    thresholds: dict = field(default_factory=dict)

    def margin(self, values: dict[str, Column]) -> Column:
        def walk(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            name, limit, low, high = node
            return F.when(values[name] <= F.lit(limit), walk(low)).otherwise(walk(high))

        total = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights, strict=True):
            total = total + F.lit(float(weight)) * walk(tree)
        return total

    def guess(self, values: dict[str, Column]) -> Column:
        """Probability by the trees alone."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * self.margin(values)))

    def probability(self, values: dict[str, Column]) -> Column:
        """One for a candidate that proves itself, else the trees' guess."""
        return F.when(values["evidence"] > 0, F.lit(1.0)).otherwise(self.guess(values))


def _tree(node) -> object:
    if node.numDescendants() == 0:
        return float(node.prediction())
    split = node.split()
    return (FEATURES[split.featureIndex()], float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _meeting(base: Column | str, loose: Column | str) -> Column:
    """array<struct<span, met>>: the spans of ``loose`` and whether they overlap one of ``base``.

    In one sweep: base spans stand at their start, the others at their end, and the greatest end of
    the base spans before such a place is beyond the start of the span that ends there or not.
    """
    loose, base = (F.col(c) if isinstance(c, str) else c for c in (loose, base))

    def event(at: Column, side: int, end: Column, place: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(side).alias("side"), end.alias("end"), place.alias("place"))

    events = F.sort_array(F.concat(
        F.transform(base, lambda b: event(b["start"], 1, b["end"], F.lit(-1))),
        F.transform(loose, lambda c, i: event(c["end"], 0, F.lit(0), i)),
    ))

    def tops(sorted_events: Column) -> Column:
        both = F.zip_with(
            sorted_events, earlier_max(sorted_events["end"]),
            lambda e, top: F.struct(e["place"].alias("place"), top.alias("top")),
        )
        return F.sort_array(F.filter(both, lambda b: b["place"] >= 0))

    def flagged(c: Column, t: Column) -> Column:
        return F.struct(c.alias("span"), (t["top"] > c["start"]).alias("met"))

    return F.zip_with(loose, let(events, tops), flagged)


def _nearby(parts: Column, span: Column) -> Column:
    """struct<text, span>: what ``features`` looks at, a span with 30 code points before and one behind it."""
    start = F.greatest(span["start"] - 30, F.lit(0))
    moved = F.struct(
        span["kind"].alias("kind"), (span["start"] - start).alias("start"), (span["end"] - start).alias("end"),
        span["found"].alias("found"),
    )
    return F.struct(piece(parts, start, span["end"] + 1).alias("text"), moved.alias("span"))


#: What a row's candidates are kept as: ``fit`` says whether one fits the trees or sets the thresholds.
SEEN = f"struct<met:boolean,fit:boolean,span:{SPAN},values:struct<{','.join(f'{n}:double' for n in [*FEATURES, 'evidence'])}>>"


def _seen(text: Column, marked: Column) -> Column:
    """array<``SEEN``>: the spans of ``_meeting`` with their features, each taken once, however many nodes look at it."""

    def one(parts: Column, m: Column) -> Column:
        def looked(near: Column) -> Column:
            values = F.struct(*[value.alias(name) for name, value in features(near["text"], near["span"]).items()])
            fit = F.pmod(F.xxhash64(near["text"]), F.lit(10)) < 7
            return F.struct(m["met"].alias("met"), fit.alias("fit"), m["span"].alias("span"), values.alias("values"))

        return let(_nearby(parts, m["span"]), looked)

    def each(found: Column) -> Column:
        seen = let(chunks(text), lambda parts: F.transform(found, lambda m: one(parts, m)))
        return F.when(F.size(found) == 0, F.array().cast(f"array<{SEEN}>")).otherwise(seen)

    return let(marked, each)


def _searched(df: DataFrame, text: str, keep: list[str], met: bool = True) -> DataFrame:
    """(_row, _pii, base, seen): columns ``keep``, the text, its base spans and its candidates, without ``met`` only those that meet no base span."""
    t = F.coalesce(F.col("_pii.text"), F.lit(""))
    held = df.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row") if keep else F.lit(None).cast("boolean").alias("_row"),
        F.struct(F.col(text).alias("text")).alias("_pii"),
    )
    found = held.select("_row", "_pii", base_spans(t).alias("base"), candidates(t).alias("loose"))
    marked = _meeting("base", "loose")
    marked = marked if met else F.filter(marked, lambda m: ~m["met"])
    none = F.array().cast(f"array<{SEEN}>")
    return found.select("_row", "_pii", "base", F.when(F.size("loose") == 0, none).otherwise(_seen(t, marked)).alias("seen"))


def _judged(found: DataFrame, known: Column | None) -> DataFrame:
    """(kind, label, real, sure, fit, features) of all candidates of ``found`` (see ``_searched``).

    Those of documents are personal data if they meet a base span or prove themselves. Those of
    sentences have their sentence's label, and the ones that need no tree are left out.
    """
    each = found.select("_row", F.explode("seen").alias("c"))
    sure = F.col("c.met") | (F.col("c.values.evidence") > 0)
    label = sure.cast("double") if known is None else known
    if known is not None:
        each = each.where(~sure)
    return each.select(
        F.col("c.span.kind").alias("kind"), label.alias("label"), F.lit(known is None).alias("real"), sure.alias("sure"),
        F.col("c.fit").alias("fit"), *[F.col(f"c.values.{n}").alias(n) for n in FEATURES],
    )


def fit_selector(df: DataFrame, text: str = "text", **params) -> Selector:
    """The selector that ``fit_found`` learns from the candidates of all rows of ``df``."""
    return fit_found(stored(_searched(df, text, []).drop("_pii")), **params)


def fit_found(
    found: DataFrame,
    sentences: int = 6_000,
    share_rows: int = 20_000,
    trees: int = 20,
    depth: int = 4,
    precision: float = 0.95,
    mistakes: float = 0.01,
    seed: int = 17,
) -> Selector:
    """Boosted trees on the candidates of all rows of ``found`` (see ``_searched``, stored) and of ``sentences`` examples.

    Candidates of the documents are labelled by base spans and ``evidence``, those of the examples by
    the pattern that made them (``PERSONAL``, ``OTHER``), none of which the trees see; so they learn
    how personal data looks and what stands before it, without the marks that prove it.
    Equal candidates are counted and weigh their number. Beyond ``share_rows`` rows an example weighs
    rows / ``share_rows`` candidates, so that the examples keep their share however many rows there are.
    Seven of ten candidates, chosen by a hash of what stands around them, fit the trees. The others that nothing proves set for
    each kind the smallest guess at and above which (hits + 1) / (all + 2) reaches ``precision`` and
    at most ``mistakes`` of the documents' own candidates lie, which all count as mistakes. A
    kind that reaches it nowhere gets no threshold and adds only spans that prove themselves.
    """
    spark = found.sparkSession
    # As an Arrow table: rows of Python objects would start Python workers of their own, which stay.
    texts, labels = zip(*examples(sentences, seed), strict=True)
    table = pa.table([pa.array(texts, pa.string()), pa.array(labels, pa.float64())], ["text", "label"])
    made = _searched(spark.createDataFrame(table), "text", ["label"])
    both = _judged(found, None).unionByName(_judged(made, F.col("_row.label")))
    share = max(1.0, found.count() / share_rows)
    weight = F.count("*") * F.when(F.col("real"), F.lit(1.0)).otherwise(F.lit(share))
    rows = stored(both.groupBy(*both.columns).agg(weight.alias("weight")))
    learned = rows.where("fit")
    # With so many bins MLlib looks at every row for its split points, not at a part of them.
    bins = max(32, math.isqrt(learned.count()) + 1)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(learned)
    model = GBTClassifier(
        featuresCol="vector", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, maxBins=bins,
        stepSize=0.3, seed=seed,
    ).fit(vectors.select("vector", "label", "weight"))
    selector = Selector(
        [_tree(tree._java_obj.rootNode()) for tree in model.trees], list(model.treeWeights)
    )
    values = {name: F.col(name) for name in FEATURES}
    cells = (
        rows.where("NOT fit AND NOT sure")
        .groupBy("kind", F.floor(selector.guess(values) * 100).alias("cell"))
        .agg(
            F.sum(F.col("label") * F.col("weight")).alias("hits"), F.sum("weight").alias("n"),
            F.sum(F.when(F.col("real"), F.col("weight")).otherwise(F.lit(0.0))).alias("own"),
        )
        .collect()
    )
    for kind in LOOSE:
        own = [c for c in cells if c["kind"] == kind]
        most = mistakes * sum(c["own"] for c in own)
        hits = n = wrong = 0
        for cell in sorted(own, key=lambda c: -c["cell"]):
            hits, n, wrong = hits + cell["hits"], n + cell["n"], wrong + cell["own"]
            if wrong > most:
                break
            if (hits + 1) / (n + 2) >= precision:
                selector.thresholds[kind] = cell["cell"] / 100
    return selector


def added_spans(seen: Column, selector: Selector) -> Column:
    """Candidates (see ``_seen``) that meet no base span and prove themselves or reach the threshold of their
    kind; of overlapping ones the likeliest, then the leftmost, stays.

    Candidates that hang together by overlaps are chosen among themselves, so a text with very many
    spans is compared with itself only where they touch.
    """
    none = F.array().cast(f"array<{SPAN}>")

    def judged(c: Column) -> Column:
        p = selector.probability({n: c["values"][n] for n in [*FEATURES, "evidence"]})
        return F.struct(c["span"]["start"].alias("at"), c["span"]["end"].alias("end"), (-p).alias("p"), c["span"].alias("span"))

    def enough(s: Column) -> Column:
        bar = F.lit(1.0)
        for kind, threshold in selector.thresholds.items():
            bar = F.when(s["span"]["kind"] == kind, F.lit(threshold)).otherwise(bar)
        return -s["p"] >= bar

    def likeliest(group: Column) -> Column:
        ranked = F.sort_array(F.transform(group, lambda s: F.struct(s["p"].alias("p"), s["at"].alias("at"), s["span"].alias("span"))))

        def step(a: Column, s: Column) -> Column:
            taken = F.exists(a, lambda b: _overlaps(s["span"], b))
            return F.when(taken, a).otherwise(F.concat(a, F.array(s["span"])))

        return F.aggregate(ranked, none, step)

    def picked(found: Column) -> Column:
        fresh = F.zip_with(found["at"], earlier_max(found["end"]), lambda at, top: at >= top)
        heads = let(fresh, lambda f: F.filter(F.sequence(F.lit(0), F.size(f) - 1), lambda i: F.get(f, i)))

        def groups(h: Column) -> Column:
            return F.transform(h, lambda i, k: F.slice(found, i + 1, F.coalesce(F.get(h, k + 1), F.size(found)) - i))

        return F.flatten(F.transform(let(heads, groups), likeliest))

    free = F.filter(seen, lambda c: ~c["met"])
    ranked = F.sort_array(F.filter(F.transform(free, judged), enough))
    return F.when(F.size(seen) == 0, none).otherwise(
        let(ranked, lambda r: F.when(F.size(r) == 0, none).otherwise(picked(r)))
    )


def find(
    df: DataFrame, text: str = "text", selector: Selector | None = None, keep: list[str] | None = None
) -> DataFrame:
    """(columns ``keep``, ``text``, ``base``, ``spans``): the base spans, and base plus added
    spans, of every row. Null and empty texts have none. Rows are judged alone; repeated
    rows get equal spans, an empty table none. A text is searched whole, in time that grows with its
    length and number of spans (times its logarithm). Without a ``selector`` one is learned from all
    rows, which are searched once and stored as Parquet with what was found. Spans are sorted by kind (base kinds as listed, then ``number``,
    ``account``), then start; ends are exclusive; positions are code points.
    """
    keep = [c for c in df.columns if c != text] if keep is None else keep
    found = _searched(df, text, keep, met=selector is None)
    if selector is None:
        found = stored(found)
        selector = fit_found(found)
    added = found.select("_row", "_pii", "base", added_spans(F.col("seen"), selector).alias("added"))
    order = F.array(*[F.lit(k) for k in [*KINDS, "number", "account"]])
    merged = F.transform(
        F.sort_array(
            F.transform(
                F.concat("base", "added"),
                lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("at"), s.alias("span")),
            )
        ),
        lambda s: s["span"],
    )
    return added.select(
        "_row", F.col("_pii.text").alias("text"), "base",
        F.when(F.size("added") == 0, F.col("base")).otherwise(merged).alias("spans"),
    )


def redact(df: DataFrame, text: str = "text", selector: Selector | None = None) -> DataFrame:
    """``df`` with every span replaced by its kind in brackets, such as ``[EMAIL]``.

    Overlapping spans become one, named by the first. Columns, their order and rows stay;
    ``n_chars``, where there is one, becomes the new length. A null text stays null.
    """
    found = find(df, text, selector)

    def rebuilt(whole: Column, spans: Column) -> Column:
        by_start = F.array_sort(
            F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        )

        def cut(parts: Column, found: Column) -> Column:
            heads = F.filter(
                F.zip_with(found, earlier_max(found["end"]), lambda s, at: F.struct(at.alias("at"), s.alias("s"))),
                lambda h: h["s"]["start"] >= h["at"],
            )
            kept = F.transform(
                heads,
                lambda h: F.concat(piece(parts, h["at"], h["s"]["start"]), F.lit("["), F.upper(h["s"]["kind"]), F.lit("]")),
            )
            last = F.array_max(found["end"])
            return F.concat(F.array_join(kept, ""), piece(parts, last, F.length(whole)))

        return let(chunks(whole), lambda parts: let(by_start, lambda found: cut(parts, found)))

    clean = F.when(F.size("spans") == 0, F.col("text")).otherwise(rebuilt(F.col("text"), F.col("spans")))
    done = found.select("_row", clean.alias("_clean"))
    columns = []
    for c in df.columns:
        if c == text:
            columns.append(F.col("_clean").alias(c))
        elif c == "n_chars":
            columns.append(F.length("_clean").cast(df.schema[c].dataType).alias(c))
        else:
            columns.append(F.col("_row").getField(c).alias(c))
    return done.select(*columns)


def digest_rows(df: DataFrame) -> DataFrame:
    """The contract's columns, one row per row of ``df``."""
    found = find(df.select("doc_id", "text"), keep=["doc_id"])
    counts = [
        F.size(F.filter("base", _of_kind(kind))).cast("long").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        *counts,
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )
