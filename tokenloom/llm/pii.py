"""Personal data by weak supervision, in DataFrame expressions only.

Candidates are the matches of fixed patterns: the four base kinds, valid or not, and looser forms of
personal data that have no base kind. Labelers (format, gazetteer, context, shape, surroundings) vote
1, -1 or 0 on each. Expectation-maximisation over the counts of vote patterns estimates how reliable
each labeler is and how likely each pattern is personal data; with these soft labels a final span
classifier (naive Bayes over votes and span features) is fitted. Base matches that pass their check
always stay; the classifier adds other candidates that meet none of them.

Everything about a text is computed in its own row, so there is no join and rows may repeat. What is
shuffled is one row per distinct pattern of votes and features, a number bounded by the labelers.
The model is a handful of literals; each step of the estimation is one aggregate of that small table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.shared import own_prefix, stage

# Kinds in the order of the contract, then the looser ones.
KINDS = ("email", "ip", "card", "phone", "email_text", "phone_local", "national_id", "person")
BASE_KINDS = 4
# Patterns. Possessive runs and the look-behind at a run's start find the same leftmost
# matches as the plain forms, in linear time and without deep recursion.
LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_text": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]++)++",
    "phone_local": r"(?<![0-9+])(?:\([0-9]{2,4}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "person": r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.? [A-Z][a-z]++(?: [A-Z][a-z]++)?+",
}
# A text without these cannot match.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]", "email_text": r"[(\[]at[)\]]",
         "phone_local": r"[0-9]{3}[.-][0-9]{4}", "national_id": r"[0-9]-[0-9]",
         "person": r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\b"}
# Gazetteers and context words.
DOMAINS = r"(?i)(?:com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|ch|at|nl|be|us)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[4-7]|6(?:011|5))"
COUNTRIES = r"^\+ ?\(?(?:1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1-6]|9[0-58])"
RESERVED = r"^0*(?:0|10|127|255|22[4-9]|23[0-9]|24[0-9]|25[0-4])\."
FIRST_NAMES = (r"\b(?:Anna|Maria|Laura|Julia|Sophie|Emma|Marie|Elena|Sarah|Lisa|Peter|Thomas|Michael|John|James|Robert|"
               r"David|Daniel|Paul|Pierre|Jean|Carlos|Jose|Juan|Luis|Hans|Klaus|Stefan|Martin|Andreas)\b")
CUES = {
    "email": r"(?i)(?:e-?mail|contact|write|reach|kontakt|correo|courriel)",
    "ip": r"(?i)(?:\bip\b|address|host|server|client|login|from)",
    "card": r"(?i)(?:card|credit|visa|master|amex|payment|karte|carte|tarjeta)",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|cell|handy|portable|m[oó]vil)",
    "person": r"(?i)(?:name|dear|contact|by|von|par|por)",
}
AGAINST = r"(?i)(?:version|release|licen[cs]e|section|chapter|figure|table|isbn|page|\bv\.?) *$"
LABELERS = ("format", "gazetteer", "context", "shape", "around")
FEATURES = ("size", "before", "after")
ROUNDS = 12
ADD_FROM = math.log(4.0)
CONTEXT = 40
CHUNK = 256


def _located(text: Column, kind: str) -> Column:
    """All leftmost non-overlapping matches of a kind with their place and surroundings.

    The pieces between matches give the places: a match starts where all pieces and matches before it
    end. Matches are added up in chunks of CHUNK, and the chunks shifted to where they begin, so that a text
    with very many matches costs in proportion to them.
    """
    pattern = PATTERNS[kind]
    number = KINDS.index(kind)

    def chunk(x: Column, first: Column) -> Column:
        def add(done: Column, i: Column) -> Column:
            match, piece = x["m"][i], x["s"][i]
            start = done["at"] + F.length(piece)
            end = start + F.length(match)
            return F.struct(end.alias("at"), F.array_append(done["out"], F.struct(
                start.alias("start"), F.lit(number).alias("kind"), end.alias("end"), match.alias("text"),
                F.right(piece, F.lit(CONTEXT)).alias("before"), F.left(x["s"][i + 1], F.lit(1)).alias("after"))).alias("out"))

        last = F.least(first + CHUNK, F.size(x["m"])) - 1
        return F.aggregate(F.sequence(first, last), F.struct(F.lit(0).alias("at"), _none().alias("out")), add)

    def joined(chunks: Column) -> Column:
        begins = F.aggregate(
            chunks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins")),
            lambda done, c: F.struct((done["at"] + c["at"]).alias("at"), F.array_append(done["begins"], done["at"]).alias("begins")),
            lambda done: done["begins"])
        shifted = F.zip_with(chunks, begins, lambda c, begin: F.transform(
            c["out"], lambda m: m.withField("start", m["start"] + begin).withField("end", m["end"] + begin)))
        return F.when(F.size(chunks) == 1, chunks[0]["out"]).otherwise(F.flatten(shifted))

    def step(x: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.size(x["m"]) - 1, F.lit(CHUNK))
        return F.transform(F.array(F.transform(firsts, lambda first: chunk(x, first))), joined)[0]

    parts = F.array(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                             F.split(text, pattern, -1).alias("s")))
    found = F.transform(parts, lambda x: F.when(F.size(x["m"]) > 0, step(x)).otherwise(_none()))[0]
    return F.when(text.rlike(NEEDS[kind]), found).otherwise(_none())


def _none() -> Column:
    return F.expr("cast(array() as array<struct<start:int,kind:int,end:int,text:string,before:string,after:string>>)")


def _any(kind: Column, of: dict[str, Column], otherwise: Column) -> Column:
    out = otherwise
    for name, value in of.items():
        out = F.when(kind == KINDS.index(name), value).otherwise(out)
    return out


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out.when(no, -1) if no is not None else out).otherwise(0)


def _votes(c: Column) -> dict[str, Column]:
    kind, text = c["kind"], c["text"]
    digits = F.regexp_replace(text, "[^0-9]", "")
    n = F.length(digits)
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    fine = _any(kind, {
        "ip": text.rlike(rf"^{part}(?:\.{part}){{3}}$"),
        "card": n.between(14, 19) & F.call_function("luhn_check", digits),
        "phone": n.between(10, 15),
        "national_id": ~text.rlike(r"^(?:000|666|9)|-00-|-0000$"),
    }, F.lit(True))
    known = _any(kind, {
        "email": _vote(text.rlike(DOMAINS)), "email_text": _vote(text.rlike(DOMAINS)),
        "ip": _vote(F.lit(False), text.rlike(RESERVED)), "card": _vote(digits.rlike(ISSUERS), F.lit(True)),
        "phone": _vote(text.rlike(COUNTRIES), F.lit(True)), "person": _vote(text.rlike(FIRST_NAMES)),
    }, F.lit(0))
    same = {"email_text": "email", "phone_local": "phone", "national_id": "card"}
    hinted = _any(kind, {k: c["before"].rlike(CUES[same.get(k, k)]) for k in KINDS}, F.lit(False))
    shaped = _any(kind, {
        "email": _vote(F.length(text) <= 60, F.lit(True)), "ip": _vote(F.length(text) >= 9, F.length(text) <= 7),
        "card": _vote(text.rlike(r"^(?:[0-9]{14,16}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$"), ~n.between(13, 19)),
        "phone": _vote(text.rlike(r"[() .-]"), n < 8),
    }, F.lit(0))
    glued = c["before"].rlike(r"[A-Za-z0-9_=/#-]$") | c["after"].rlike(r"[A-Za-z0-9_=/%-]")
    return {"format": _vote(fine, F.lit(True)), "gazetteer": known, "context": _vote(hinted, c["before"].rlike(AGAINST)),
            "shape": shaped, "around": _vote(F.lit(False), glued)}


def _features(c: Column) -> dict[str, Column]:
    def sort_of(x: Column) -> Column:
        return (F.when(x == "", 0).when(x.rlike(r"\s$"), 1).when(x.rlike(r"[0-9]$"), 2)
                .when(x.rlike(r"\p{L}$"), 3).otherwise(4))

    return {"size": F.least(F.length(c["text"]) / 4, F.lit(8)).cast("int"), "before": sort_of(c["before"]),
            "after": sort_of(c["after"])}


def candidates(text: Column) -> Column:
    """Array of all candidates of a text, with votes, features and whether it is a base span."""
    every = F.concat(*[_located(text, kind) for kind in KINDS])

    def judged(c: Column) -> Column:
        return F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"),
                        *[v.alias(k) for k, v in (_votes(c) | _features(c)).items()])

    return F.transform(F.transform(every, judged), lambda c: c.withField("base", (c["kind"] < BASE_KINDS) & (c["format"] == 1)))


@dataclass(frozen=True)
class SpanModel:
    reliability: dict
    """labeler -> vote -> (chance given personal data, chance given other text)"""
    prior: dict
    """kind -> share of personal data"""
    odds: dict
    """votes and features of the final classifier: name -> value -> log odds; `kind` has the priors"""


def fit(texts: DataFrame, rounds: int = ROUNDS) -> SpanModel:
    """Estimate the model from all candidates of `texts` (a column `text`)."""
    names = [*LABELERS, *FEATURES]
    table = stage(
        texts.select(F.explode(candidates(F.coalesce("text", F.lit("")))).alias("c"))
        .groupBy("c.kind", *[f"c.{n}" for n in names]).agg(F.count("*").cast("double").alias("n")).coalesce(1), "votes")
    # Start: a labeler is right four times in five.
    start = {1: (0.6, 0.15), 0: (0.25, 0.25), -1: (0.15, 0.6)}
    reliability = {j: dict(start) for j in LABELERS}
    prior = dict.fromkeys(range(len(KINDS)), 0.5)

    def chance() -> Column:
        odds = _lookup(F.col("kind"), {k: math.log(p / (1 - p)) for k, p in prior.items()})
        for j in LABELERS:
            odds = odds + _lookup(F.col(j), {v: math.log(a / b) for v, (a, b) in reliability[j].items()})
        return 1 / (1 + F.exp(-odds))

    def sums(of: list[str]) -> dict:
        """{(name, value): (expected personal, expected other)} for the columns `of`, and for all rows."""
        seen = table.select("n", chance().alias("q"), F.explode(F.array(
            F.struct(F.lit("").alias("name"), F.lit(0).alias("value")),
            *[F.struct(F.lit(c).alias("name"), F.col(c).cast("int").alias("value")) for c in of])).alias("e"))
        rows = seen.groupBy("e.name", "e.value").agg(
            F.sum(F.col("n") * F.col("q")).alias("y"), F.sum(F.col("n") * (1 - F.col("q"))).alias("x")).collect()
        return {(r["name"], r["value"]): (r["y"], r["x"]) for r in rows}

    for _ in range(rounds):
        got = sums(["kind", *LABELERS])
        yes, no = got.get(("", 0), (0.0, 0.0))
        of = lambda name, v: got.get((name, v), (0.0, 0.0))
        reliability = {j: {v: ((of(j, v)[0] + 1) / (yes + 3), (of(j, v)[1] + 1) / (no + 3)) for v in (-1, 0, 1)}
                       for j in LABELERS}
        prior = {k: (of("kind", k)[0] + 1) / (sum(of("kind", k)) + 2) for k in prior}
    got = sums(names)
    yes, no = (x + 8 for x in got.get(("", 0), (0.0, 0.0)))
    odds: dict = {"kind": {k: math.log(p / (1 - p)) for k, p in prior.items()}} | {name: {} for name in names}
    for (name, value), (y, x) in got.items():
        if name:
            odds[name][value] = math.log((y + 1) / yes) - math.log((x + 1) / no)
    return SpanModel(reliability, prior, odds)


def _is_kind(number: int):
    return lambda c: c["kind"] == number


def _meets(spans: Column, c: Column) -> Column:
    """Whether `c` overlaps one of the ordered, disjoint `spans`: only the last that begins before its end can."""
    rounds = F.sequence(F.lit(1), F.length(F.bin(F.size(spans).cast("bigint"))).cast("int"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        before, going = F.get(spans, mid)["start"] < c["end"], s["lo"] < s["hi"]
        return F.struct(F.when(going & before, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(going & ~before, mid).otherwise(s["hi"]).alias("hi"))

    begun = F.aggregate(rounds, F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi")), halve, lambda s: s["lo"])
    return F.coalesce((F.size(spans) > 0) & (F.get(spans, begun - 1)["end"] > c["start"]), F.lit(False))


def _lookup(key: Column, values: dict[int, float]) -> Column:
    out = F.lit(0.0)
    for k, v in values.items():
        out = F.when(key == k, float(v)).otherwise(out)
    return out


OUTPUTS = ("n_email", "n_ip", "n_card", "n_phone", "n_added", "base_sha256", "spans")


def _texts_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda c: F.struct(c["start"], c["kind"], c["end"])))
    return F.array_join(F.transform(ordered, lambda c: F.concat_ws(":", F.get(names, c["kind"]), c["start"], c["end"])), ",")


def find_personal_data(docs: DataFrame, model: SpanModel) -> DataFrame:
    """`docs` with n_email, n_ip, n_card, n_phone, n_added, base_sha256 and spans; all columns stay.

    A null text counts as empty; a text without spans has the digest of the empty string and an empty
    `spans`. Spans are kind:start:end in code points, end exclusive, by start and then kind. Columns of
    these names are replaced.
    """
    def personal(c: Column, base: list[Column]) -> Column:
        score = _lookup(c["kind"], model.odds["kind"])
        for name in (*LABELERS, *FEATURES):
            score = score + _lookup(c[name], model.odds[name])
        return reduce(lambda clear, spans: clear & ~_meets(spans, c), base, ~c["base"] & (score >= ADD_FROM))

    def added_to(x: Column) -> Column:
        # Base spans of one kind are apart from each other and in order.
        kinds = F.struct(*[F.filter(x["base"], _is_kind(k)).alias(f"k{k}") for k in range(BASE_KINDS)])
        return F.transform(F.array(kinds), lambda of: F.filter(
            x["found"], lambda c: personal(c, [of[f"k{k}"] for k in range(BASE_KINDS)])))[0]

    def result(x: Column) -> Column:
        """All outputs of a text from its candidates and the base ones among them."""
        added = F.when(F.size(x["found"]) > F.size(x["base"]), added_to(x))
        added = F.coalesce(added, F.slice(x["base"], 1, 0))
        counts = [F.size(F.filter(x["base"], _is_kind(k))).cast("long").alias(f"n_{name}")
                  for k, name in enumerate(KINDS[:BASE_KINDS])]
        return F.struct(*counts, F.size(added).cast("long").alias("n_added"),
                        F.sha2(_texts_of(x["base"]), 256).alias("base_sha256"),
                        _texts_of(F.concat(x["base"], added)).alias("spans"))

    # Arrays of one element name a value inside an expression, so that it is computed once.
    found = F.array(candidates(F.coalesce("text", F.lit(""))))
    both = F.transform(found, lambda f: F.struct(f.alias("found"), F.filter(f, lambda c: c["base"]).alias("base")))
    out = f"{own_prefix(docs, '_found_')}out"
    return docs.withColumn(out, F.get(F.transform(both, result), F.lit(0))).select(
        *[c for c in docs.columns if c not in OUTPUTS], f"{out}.*")


def redact(docs: DataFrame, found: str = "spans") -> DataFrame:
    """`docs` with `redacted`: the text with the kind's name in place of every span of `found`.

    Spans that begin inside an earlier one are covered by it.
    """
    def put(done: Column, span: Column) -> Column:
        part = F.split(span, ":")
        start, end = part[1].cast("int"), part[2].cast("int")
        kept = F.substring(F.coalesce("text", F.lit("")), done["at"] + 1, start - done["at"])
        return F.when(start < done["at"], done).otherwise(F.struct(
            end.alias("at"), F.concat(done["out"], kept, F.lit("["), part[0], F.lit("]")).alias("out")))

    text = F.coalesce("text", F.lit(""))
    spans = F.filter(F.split(found, ","), lambda s: s != "")
    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), put)
    return docs.withColumn("redacted", F.when(F.col("text").isNotNull(), F.concat(
        done["out"], F.substring(text, done["at"] + 1, F.length(text)))))
