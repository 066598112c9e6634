"""Personal data: generators propose spans, boosted trees score them, calibrated thresholds choose.

Built from DataFrame functions only; a document is handled in its own row, so nothing is shuffled.

1. Base patterns find the spans that stay in any case (email, ip, card, phone).
2. Generators with high recall propose more spans, which may overlap: spelt-out emails, phones without
   a plus, cards with other separators, loosely written addresses.
3. Trees over the format of a span and the words around it score each proposal.  They are fitted on the driver on
   a fixed number of written examples, whose features the same SQL computes, and become CASE expressions.
4. A proposal is taken if its score reaches the threshold of its kind and it overlaps no base span and
   no better proposal that starts before it ends.

Positions are code points, ends exclusive.

Defined results
---------------
* a null text counts as empty and has no spans; ids pass through, repeated or null;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import boosting
from tessera.llm.common import spread, table

KINDS = ("email", "ip", "card", "phone")

# Base patterns.  Possessive forms match what the greedy ones do, without steps back: nothing behind a
# run can match a shorter run.  A match starts at the start of a run or where the last match ended.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Proposals beyond the base.
MORE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++ ?(?:\[at\]|\(at\)|\{at\}| at |@) ?[a-z0-9-]++(?:(?: ?(?:\[dot\]|\(dot\)|\{dot\}) ?| dot |\.)[a-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?: ?(?:\.|\[\.\]|\(\.\)) ?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ ._/-]{1,3}[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+])(?:00 ?[0-9]{1,3}[ .-])?\(?[0-9]{2,4}\)?[ ./-]{1,2}[0-9]{3,4}[ ./-]?[0-9]{3,4}(?![0-9])",
}
# What has to stand in a text before a pattern is tried.
NEEDS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9]", "phone": "\\+[0-9]"}
NEEDS_MORE = {"email": "(?i)@|[\\[({ ]at[\\]) }]", "ip": "[0-9] ?[\\[(]?\\.", "card": "[0-9]{4}[ ._/-]", "phone": "[0-9]{3}"}
# Words that speak for a kind, and words that speak against all.
CUES = {
    "email": "e-?mail|mail|contact|write|reach",
    "ip": "\\bip\\b|host|server|address|login",
    "card": "card|visa|credit|mastercard|amex|karte|tarjeta|carte",
    "phone": "phone|tel|call|mobile|cell|fax|whatsapp|anruf|llam|appel",
}
AGAINST = "version|release|isbn|issn|order|invoice|serial|page|pages|ref|figure|table|score|ratio|year|date|section|step|#|\\$|€"

LEFT, RIGHT = 28, 12
#: Spans of a run.
CHUNK = 128
#: Written examples; precision that a threshold has to reach on those kept for it.
EXAMPLES = 6_000
PRECISION = 0.98
FIELDS = (
    "kind chars digits letters seps distinct luhn octets parens longest left_word left_sign right_word right_sign cue against domain "
    "spelt zeros"
).split()


def let(value: Column, body) -> Column:
    """body(value), with value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chunked(items: Column) -> Column:
    """items in runs of CHUNK.  Lists grow inside a run only, so the work is not quadratic in the matches of a text."""
    last = F.floor((F.size(items) - 1) / CHUNK).cast("int")
    return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.slice(items, i * CHUNK + 1, CHUNK))


def spans(text: Column, pattern: str, needs: str) -> Column:
    """array<struct<s, e, v>> of the non-overlapping matches of pattern, leftmost first."""
    none = F.array().cast("array<struct<s:int,e:int,v:string>>")
    pairs = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda g, v: F.struct(F.length(g).alias("gap"), F.length(v).alias("n"), v.alias("v")),
    )
    pairs = F.filter(pairs, lambda x: x["v"].isNotNull())  # behind the last match stands a gap alone

    def place(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        e = s + x["n"]
        here = F.array(F.struct(s.alias("s"), e.alias("e"), x["v"].alias("v")))
        return F.struct(e.alias("at"), F.concat(acc["out"], here).alias("out"))

    def starts(runs: Column) -> Column:
        step = lambda acc, run: F.struct(
            (acc["at"] + F.aggregate(run, F.lit(0), lambda n, x: n + x["gap"] + x["n"])).alias("at"),
            F.concat(acc["out"], F.array(acc["at"])).alias("out"),
        )
        return F.aggregate(runs, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), step, lambda acc: acc["out"])

    def placed(runs: Column) -> Column:
        each = lambda run, at: F.aggregate(run, F.struct(at.alias("at"), none.alias("out")), place, lambda acc: acc["out"])
        return F.flatten(F.zip_with(runs, starts(runs), each))

    return F.when(text.rlike(needs), let(pairs, lambda x: let(chunked(x), placed))).otherwise(none)


def indexed(items: Column) -> Column:
    """Spans of all kinds as runs with their bounds; spans of one kind are in order and do not overlap."""
    own = lambda i: let(F.filter(items, lambda c: c["k"] == i), chunked)
    runs = F.filter(F.concat(*(own(i) for i in range(len(KINDS)))), lambda r: F.size(r) > 0)
    return F.transform(runs, lambda r: F.struct(F.get(r, F.lit(0))["s"].alias("lo"), F.element_at(r, -1)["e"].alias("hi"), r.alias("items")))


def meets(index: str, c: Column, more=None) -> Column:
    """Whether a span of the index overlaps c (and fulfils ``more``)."""

    def hit(o: Column) -> Column:
        over = (o["s"] < c["e"]) & (c["s"] < o["e"])
        return over if more is None else over & more(o)

    return F.exists(index, lambda r: (r["lo"] < c["e"]) & (c["s"] < r["hi"]) & F.exists(r["items"], hit))


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether 13 to 19 digits pass Luhn's check."""
    padded = F.lpad(digits, 19, "0")
    total = F.lit(0)
    for i in range(19):
        d = F.substring(padded, i + 1, 1).cast("int")
        total = total + (d if i % 2 == 0 else F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d + 1))
    return F.length(digits).between(13, 19) & (total % 10 == 0)


def octets_fit(v: Column) -> Column:
    parts = F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0))
    return F.forall(parts, lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=.)", "").try_cast("int"), F.lit(256)) <= 255)


def holds(kind: str, v: Column) -> Column:
    """The check that a match of a base pattern has to pass."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return octets_fit(v)
    if kind == "card":
        return luhn(_digits(v))
    return F.length(_digits(v)).between(9, 15)


def features(kind: str, text: Column, c: Column) -> Column:
    """Struct of FIELDS for a proposal c (s, e, v) in text."""
    v, digits = c["v"], _digits(c["v"])
    start = F.greatest(c["s"] - LEFT, F.lit(0))
    left = F.lower(F.substr(text, start + 1, c["s"] - start))
    right = F.substr(text, c["e"] + 1, F.lit(RIGHT))
    flag = lambda x: x.cast("double")
    made = {
        "kind": F.lit(float(KINDS.index(kind))),
        "chars": F.length(v).cast("double"),
        "digits": F.length(digits).cast("double"),
        "letters": F.length(F.regexp_replace(v, "[^A-Za-z]", "")).cast("double"),
        "seps": F.length(F.regexp_replace(v, "[A-Za-z0-9]", "")).cast("double"),
        "distinct": F.size(F.array_distinct(F.split(digits, ""))).cast("double"),
        "luhn": flag(luhn(digits)),
        "octets": flag(octets_fit(v)),
        "parens": flag(v.contains("(")),
        "longest": F.coalesce(F.array_max(F.transform(F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0)), F.length)), F.lit(0)).cast("double"),
        "left_word": flag(left.rlike("[\\p{L}\\p{N}_]$")),
        "left_sign": flag(left.rlike("[.,/:=#$€%*+-] ?$")),
        "right_word": flag(right.rlike("^[\\p{L}\\p{N}_]")),
        "right_sign": flag(right.rlike("^(?:[/:=%*+-]|[.,][0-9])")),
        "cue": flag(left.rlike(CUES[kind])),
        "against": flag(left.rlike(AGAINST)),
        "domain": flag(v.rlike("(?i)(?:\\.|dot[\\])}]? ?)(?:com|org|net|edu|gov|io|de|fr|es|uk|info)$")),
        "spelt": flag(v.rlike("(?i)[\\[({ ](?:at|dot)[\\]) }]|\\[\\.\\]|\\(\\.\\)")),
        "zeros": flag(v.rlike("(?:^|[^0-9])0[0-9]")),
    }
    return F.struct(*(made[f].alias(f) for f in FIELDS))


def _examples(n: int, seed: int = 11) -> list[tuple[str, int, str, int]]:
    """(kind, label, text before, span, text after) as (kind, label, text, start): personal data in
    unusual spellings, and look-alikes."""
    r = random.Random(seed)
    filler = "the of and here now or then with some more note see line item next old new their this".split()
    cues = {k: [w.replace("\\b", "").replace("-?", "") for w in v.split("|")] for k, v in CUES.items()}
    against = [w for w in AGAINST.split("|") if w.isalpha()]
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("abcdefghiklmnoprstuvw") for _ in range(r.randint(3, 9)))

    def luhn_ok(d: str) -> bool:
        return sum((int(c) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)]) for i, c in enumerate(reversed(d))) % 10 == 0

    def card(valid: bool) -> str:
        while True:
            d = r.choice("3456") + digits(15)
            if luhn_ok(d) == valid:
                return r.choice([".", "/", " - ", "  ", "_"]).join(d[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return r.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"00{r.randint(1, 99)} {a} {b} {c}"])

    def email(spelt: bool) -> str:
        tld = r.choice("com org net edu de fr io".split())
        at, dot = r.choice([(" at ", " dot "), ("[at]", "[dot]"), ("(at)", "(dot)"), (" [at] ", ".")]) if spelt else (" @ ", ".")
        return f"{word()}{r.choice(['.', '_', ''])}{word()}{at}{word()}{dot}{tld}"

    def ip(fits: bool) -> str:
        parts = [str(r.randint(1, 255) if fits else r.randint(256, 999)) for _ in range(4)]
        return r.choice([" . ", "[.]", "(.)"]).join(parts) if fits or r.random() < 0.5 else ".".join(parts)

    out = []
    for _ in range(n):
        kind, label = r.choice(KINDS), int(r.random() < 0.5)
        if label:
            span = {"card": lambda: card(True), "phone": phone, "email": lambda: email(r.random() < 0.8), "ip": lambda: ip(True)}[kind]()
            cue = r.choice(cues[kind]) if kind != "ip" and r.random() < 0.75 or kind == "ip" else ""
            if kind == "phone" and "(" not in span and not cue:
                cue = r.choice(cues[kind])
        else:
            span = {
                "card": lambda: card(False),
                "phone": lambda: r.choice(
                    [f"{r.randint(1900, 2030)}-{digits(4)}", f"{r.randint(10, 99)}.{digits(3)}.{digits(3)}", f"{digits(4)}/{digits(4)}",
                     f"{digits(3)} {digits(3)} {digits(3)}", f"{digits(4)} {digits(4)}", f"{digits(3)}-{digits(4)}", phone()]),
                "email": lambda: f"{word()} at {word()}.{r.choice([word(), word() + 'es', word() + '.' + word()])}",
                "ip": lambda: r.choice([ip(False), " . ".join(str(r.randint(0, 30)) for _ in range(4))]),
            }[kind]()
            cue = r.choice(against) if r.random() < 0.6 and kind != "email" or kind == "phone" and "(" in span else ""
            if kind == "phone" and span.count("-") == 2 and not cue:
                cue = r.choice(against)
        before = " ".join(r.choice(filler) for _ in range(r.randint(0, 3)))
        before += f" {cue}{r.choice(['', ':', ' is', ' no.' if not label else ':'])}" if cue else ""
        before = f"{before} " if before else ""
        after = r.choice(["", ".", ",", f" {r.choice(filler)}", f" {r.choice(filler)} {r.choice(filler)}", "%" if not label else ""])
        out.append((kind, label, before + span + after, len(before), len(before) + len(span)))
    return out


@lru_cache(maxsize=4)
def _fitted(_session: int, spark: SparkSession) -> tuple[boosting.Forest, dict[str, float]]:
    import json

    made = _examples(EXAMPLES)
    said = json.dumps([{"i": i, "kind": k, "y": y, "t": t, "s": s, "e": e} for i, (k, y, t, s, e) in enumerate(made)])
    rows = spark.range(1).select(F.inline(F.from_json(F.lit(said), "array<struct<i:int,kind:string,y:int,t:string,s:int,e:int>>")))
    c = F.struct("s", "e", F.expr("substr(t, s + 1, e - s)").alias("v"))
    rows = rows.select("*", c.alias("c"))
    x = F.coalesce(*(F.when(F.col("kind") == k, features(k, F.col("t"), F.col("c"))) for k in KINDS))
    got = sorted(rows.select("i", "kind", "y", x.alias("x")).collect(), key=lambda q: q["i"])
    x, y = np.array([list(q["x"]) for q in got]), np.array([q["y"] for q in got], float)
    fold = np.arange(len(y)) % 10
    forest = boosting.fit(x[fold < 6], y[fold < 6], x[(fold >= 6) & (fold < 8)], y[(fold >= 6) & (fold < 8)], trees=40)
    least = {}
    for i, kind in enumerate(KINDS):
        of = (fold >= 8) & (x[:, 0] == i)
        score, truth = forest.score(x[of]), y[of]
        tries = [t for t in np.unique(np.round(forest.scores, 6)) if t >= 0.5 and (score >= t).any() and truth[score >= t].mean() >= PRECISION]
        least[kind] = float(min(tries, default=2.0))
    return forest, least


def fitted(spark: SparkSession) -> tuple[boosting.Forest, dict[str, float]]:
    """Trees and the threshold of each kind, fitted once a session."""
    return _fitted(id(spark._jsparkSession), spark)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text, base and all_spans: arrays of struct<k (index in KINDS), s, e> in order of kind and start."""
    forest, least = fitted(docs.sparkSession)
    rows = spread(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    text = F.col("text")
    kept = "array<struct<k:int,s:int,e:int>>"
    tag = lambda k, found: F.transform(found, lambda c: F.struct(F.lit(k).alias("k"), c["s"].alias("s"), c["e"].alias("e")))
    checked = lambda k: lambda c: holds(k, c["v"])
    base = [tag(i, F.filter(spans(text, BASE[k], NEEDS[k]), checked(k))) for i, k in enumerate(KINDS)]
    rows = rows.select("*", F.concat(*base).cast(kept).alias("base"))
    rows = rows.select("*", indexed(F.col("base")).alias("base_index"))
    proposed = []
    for i, k in enumerate(KINDS):
        margin = forest.margin_for(least[k])
        if not np.isfinite(margin):
            continue
        proposed.append(_scored(forest, margin, text, i, k))
    if not proposed:
        return rows.select("*", F.col("base").alias("all_spans"))
    rows = rows.select("*", F.concat(*proposed).alias("more"))
    rows = rows.select("*", indexed(F.col("more")).alias("more_index"))
    better = lambda c: lambda o: (
        (o["m"] > c["m"]) | ((o["m"] == c["m"]) & ((o["k"] < c["k"]) | ((o["k"] == c["k"]) & (o["s"] < c["s"]))))
    )
    beaten = lambda c: meets("more_index", c, better(c))
    chosen = F.transform(
        F.filter("more", lambda c: ~beaten(c)), lambda c: F.struct(c["k"].alias("k"), c["s"].alias("s"), c["e"].alias("e"))
    )
    return rows.select("doc_id", "text", "base", F.array_sort(F.concat("base", chosen)).alias("all_spans"))


def _scored(forest: boosting.Forest, margin: float, text: Column, number: int, kind: str) -> Column:
    """Proposals of a kind that no base span overlaps and whose margin reaches the threshold."""
    free = F.filter(
        spans(text, MORE[kind], NEEDS_MORE[kind]),
        lambda c: ~meets("base_index", c),
    )
    made = F.transform(free, lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), features(kind, text, c).alias("x")))
    scored = F.transform(
        made, lambda c: F.struct(F.lit(number).alias("k"), c["s"].alias("s"), c["e"].alias("e"), _margin(forest, c["x"]).alias("m"))
    )
    return F.filter(scored, lambda c: c["m"] >= margin)


def _margin(forest: boosting.Forest, x: Column) -> Column:
    """The trees as CASE expressions over the fields of x."""

    def branch(t: int, node: int) -> Column:
        inner = forest.feature.shape[1]
        if node >= inner:
            return F.lit(float(forest.leaf[t, node - inner]))
        if not np.isfinite(forest.cut[t, node]):
            return branch(t, 2 * node + 1)
        over = x[FIELDS[forest.feature[t, node]]] > float(forest.cut[t, node])
        return F.when(over, branch(t, 2 * node + 2)).otherwise(branch(t, 2 * node + 1))

    total = F.lit(forest.base)
    for t in range(len(forest.leaf)):
        total = total + branch(t, 0)
    return total


def redact(docs: DataFrame) -> DataFrame:
    """doc_id, text with every span replaced by its kind in brackets (overlapping spans as one)."""
    found = find(docs)
    order = F.array_sort(F.transform("all_spans", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), c["k"].alias("k"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def step(acc: Column, c: Column) -> Column:
        fresh = F.concat(acc["out"], F.expr("text").substr(acc["at"] + 1, c["s"] - acc["at"]), F.element_at(names, c["k"] + 1))
        return F.struct(F.greatest(acc["at"], c["e"]).alias("at"), F.when(c["s"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(order, start, step)
    rest = F.substr(F.col("text"), F.col("r.at") + 1, F.length("text"))
    return found.select("doc_id", "text", done.alias("r")).select("doc_id", F.concat("r.out", rest).alias("text"))


def _said(array: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(array, lambda c: F.concat_ws(":", F.element_at(names, c["k"] + 1), c["s"].cast("string"), c["e"].cast("string"))), ","
    )


def report(docs: DataFrame) -> DataFrame:
    found = find(docs)
    count = lambda i: F.size(F.filter("base", lambda c: c["k"] == i)).cast("long")
    return found.select(
        "doc_id",
        *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(_said("base"), 256).alias("base_sha256"),
        _said("all_spans").alias("spans"),
    )


def query(spark, sf_dir):
    return report(table(spark, sf_dir, "documents"))
