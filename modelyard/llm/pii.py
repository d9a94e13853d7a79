"""Personal data by weak supervision, in DataFrame and SQL functions only.

Candidates come from wide patterns. On each, labelers vote for (1), against (-1) or not
at all (0): the strict pattern, the kind's own validation, a gazetteer (domain endings,
issuer prefixes, reserved address blocks, calling codes), words before the candidate, the
characters that touch it, and the regularity of its grouping. Votes are aggregated into
counts per kind and vote pattern, at most 4 * 3^6 cells whatever the size of the table.
On these cells expectation-maximisation estimates how reliable each labeler is and the
chance that a candidate is personal data. A logistic classifier is then trained on the
cells, weighted by those chances, and joins the model as a native expression.

Result spans are the strict matches (which always stay) and the further candidates that
the classifier accepts and that touch no strict match. Offsets are code points.

The strict patterns scan without backtracking: possessive quantifiers and a start that
cannot lie inside a run give the same matches as the plain patterns.

Defined cases: null is an empty text without spans; a candidate of several kinds is a
span of each strict kind, added spans take the first kind; repeated rows get equal answers;
without candidates nothing is learnt and no span is added.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored, whole_row

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 40  # of expectation-maximisation
START = 0.8  # chance at first that a vote is right
PRIOR = 10.0  # imagined votes behind that chance
ADD = 0.9  # probability from which the classifier adds a span
CONTEXT = 24  # characters before a candidate that the context labeler reads

# The strict patterns, in forms that do not backtrack.
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Wide patterns of further candidates.
WIDE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]++)++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,}+",
    "phone": r"(?<![0-9A-Za-z+(.-])(?<![0-9] )(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{2,4}(?:[ .-][0-9]{2,5})++(?![0-9A-Za-z])",
}
# Fixed values of the gazetteers.
ENDINGS = r"\.(?i:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|ch|at|it|nl|test|example)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)"
RESERVED = r"^0*(?:0|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
CALLING = r"^(?:1|7|2[07]|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
SAID = {
    "email": r"(?i)(?:mail|contact|write|kontakt|correo|courriel)\W*$",
    "ip": r"(?i)(?:\bip|address|host|server|adresse|from)\W*$",
    "card": r"(?i)(?:card|visa|master|credit|kredit|karte|carte|tarjeta)\W*$",
    "phone": r"(?i)(?:tel|phone|call|fax|mobile|cell|ruf|num[eé]ro|llam)\w*\W*$",
}
AGAINST = r"(?i)(?:version|isbn|sku|order|serial|token|password|sha|md5|hash|id)\W*$|[A-Za-z_=#/\\]$"
MARK, OTHER = "\ue000", "\ue001"  # the second stands for the first in texts that hold it
LABELERS = ("strict", "valid", "gazetteer", "context", "edges", "grouping")
_SPANS = "array<struct<start:int,kind:int,end:int,base:boolean,votes:array<int>,digits:int>>"
_CANDIDATE = "struct<start:int,end:int,value:string,before:string,after:string>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a computed value several times, computing it once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    def term(i: Column) -> Column:
        d = F.substring(number, -i, F.lit(1)).cast("int") * (2 - i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda a, i: a + term(i))
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    n = F.length(digits(value))
    if kind == "card":
        return F.when(n.between(14, 19), let(digits(value), luhn)).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    if kind == "ip":
        return value.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)(?:\.|$)){4}$")
    return F.lit(True)


def found(text: Column, pattern: str) -> Column:
    """All matches of a pattern, leftmost first and without overlap, with their places."""
    marked = F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(OTHER)), F.lit(pattern), F.lit(f"{MARK}$0{MARK}"))

    def collect(parts: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_CANDIDATE}>").alias("out"))

        def step(state: Column, i: Column) -> Column:
            before, value, after = (F.element_at(parts, i + k) for k in (-1, 0, 1))
            start = state["at"] + F.length(before)
            end = start + F.length(value)
            near = F.substring(before, -CONTEXT, CONTEXT)
            one = F.struct(
                start.alias("start"), end.alias("end"), value.alias("value"), near.alias("before"),
                F.substring(after, 1, 1).alias("after"),
            )
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

        places = F.sequence(F.lit(2), F.size(parts) - 1, F.lit(2))
        return F.when(F.size(parts) > 1, F.aggregate(places, begin, step, lambda s: s["out"])).otherwise(begin["out"])

    return let(F.split(marked, MARK), collect)


def _grouping(value: Column) -> Column:
    """1 for groups of equal or usual sizes, -1 for mixed separators."""
    kinds = F.length(F.array_join(F.array_distinct(F.regexp_extract_all(value, F.lit("([ .-])"), F.lit(1))), ""))
    return F.when(kinds > 2, -1).when(value.rlike(r"^\(?\+?[0-9() ]*[0-9]{3,4}(?:[ .-][0-9]{3,4})+$"), 1).otherwise(0)


def _votes(kind: str, strict: bool, c: Column) -> list[Column]:
    value, number = c["value"], digits(c["value"])
    listed = {
        "email": F.when(value.rlike(ENDINGS), 1).otherwise(0),
        "ip": F.when(value.rlike(RESERVED), -1).otherwise(1),
        "card": F.when(number.rlike(ISSUERS), 1).otherwise(-1),
        "phone": F.when(number.rlike(CALLING), 1).otherwise(0),
    }[kind]
    touched = c["before"].rlike(r"[A-Za-z0-9_]$") | c["after"].rlike(r"^[A-Za-z0-9_@]")
    return [
        F.lit(int(strict)), F.when(valid(kind, value), 1).otherwise(-1), listed,
        F.when(c["before"].rlike(SAID[kind]), 1).when(c["before"].rlike(AGAINST), -1).otherwise(0),
        F.when(touched, -1).otherwise(0), _grouping(value),
    ]


def _candidates(text: Column) -> Column:
    """All candidates of a text: kind, place, whether strict and passing, votes and digits."""
    def reader(kind: str, strict: bool) -> Callable[[Column], Column]:
        return lambda c: F.struct(
            c["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), c["end"].alias("end"),
            (F.lit(strict) & valid(kind, c["value"])).alias("base"),
            F.array(*[v.cast("int") for v in _votes(kind, strict, c)]).alias("votes"),
            F.least(F.length(digits(c["value"])), F.lit(20)).alias("digits"),
        )

    return F.concat(*[
        F.when(_worth(kind, strict, text), F.transform(found(text, pattern), reader(kind, strict)))
        .otherwise(F.array().cast(_SPANS))
        for strict, patterns in ((True, STRICT), (False, WIDE)) for kind, pattern in patterns.items()
    ])


def _worth(kind: str, strict: bool, text: Column) -> Column:
    """A cheap test that a text can match at all."""
    if kind == "email":
        return F.contains(text, F.lit("@")) if strict else text.rlike(r"(?i)[(\[]at[)\]]")
    if kind == "phone" and strict:
        return F.contains(text, F.lit("+"))
    return text.rlike({"ip": r"[0-9]\.[0-9]", "card": "[0-9][0-9 -][0-9]", "phone": "[0-9][ .)-]"}[kind])


def candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """(doc, spans): rows as structs with the candidates of their whole text."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(whole_row(df).alias("doc"), _candidates(body).alias("spans"))


# --- the label model and the classifier ---------------------------------------


@dataclass(frozen=True)
class SpanModel:
    """Reliabilities per kind and labeler, and the classifier's coefficients."""

    reliability: dict = field(default_factory=dict)
    weights: tuple[float, ...] = ()
    intercept: float = -math.inf

    def probability(self, kind: Column, votes: Column, digits_: Column) -> Column:
        if not self.weights:
            return F.lit(0.0)
        terms = F.zip_with(_features(kind, votes, digits_), F.array(*map(F.lit, self.weights)), lambda x, w: x * w)
        return 1 / (1 + F.exp(-F.aggregate(terms, F.lit(self.intercept), lambda a, x: a + x)))


def _features(kind: Column, votes: Column, n: Column) -> Column:
    """Kind and each vote as indicators, and classes of the number of digits."""
    of = [(kind == k) for k in range(len(KINDS))]
    of += [F.element_at(votes, i + 1) == v for i in range(len(LABELERS)) for v in (-1, 1)]
    of += [n.between(a, b) for a, b in ((0, 6), (7, 9), (10, 12), (13, 16), (17, 20))]
    return F.array(*[F.when(x, 1.0).otherwise(0.0) for x in of])


def chances(cells: list[tuple[int, tuple[int, ...], float]], rounds: int = ROUNDS) -> tuple[list[float], dict]:
    """Expectation-maximisation over (kind, votes, count) cells.

    Every labeler has, for either truth, a chance of each vote; the truth has a chance per
    kind. Strict candidates that pass validation are known to be true, and each labeler
    begins with `PRIOR` imagined votes that are right with the chance `START`, so a table
    without counter-examples does not turn labelers round. Returns the chance of truth per
    cell and the estimates.
    """
    labelers = range(len(LABELERS))
    known = [votes[0] == 1 and votes[1] == 1 for _, votes, _ in cells]
    right = {1: START * 0.75, 0: 0.25, -1: (1 - START) * 0.75}
    prior = {(i, v, truth): PRIOR * right[v if truth else -v] for i in labelers for v in (-1, 0, 1) for truth in (0, 1)}
    prior |= {(kind, truth): PRIOR / 2 for kind in range(-len(KINDS), 0) for truth in (0, 1)}

    def logs(table: dict) -> dict:
        out = {}
        for truth in (0, 1):
            for i in labelers:
                total = sum(table[i, v, truth] for v in (-1, 0, 1))
                out |= {(i, v, truth): math.log(table[i, v, truth] / total) for v in (-1, 0, 1)}
            out |= {(k, truth): math.log(table[k, truth]) for k in range(-len(KINDS), 0)}
        return out

    table, belief = logs(prior), []
    for _ in range(rounds if cells else 0):
        belief = []
        for (kind, votes, _), sure in zip(cells, known):
            for_, against = (table[kind - len(KINDS), t] + sum(table[i, v, t] for i, v in enumerate(votes)) for t in (1, 0))
            belief.append(1.0 if sure else 1 / (1 + math.exp(min(700.0, max(-700.0, against - for_)))))
        counts = dict(prior)
        for (kind, votes, n), p in zip(cells, belief):
            for truth, weight in ((1, n * p), (0, n * (1 - p))):
                counts[kind - len(KINDS), truth] += weight
                for i, v in enumerate(votes):
                    counts[i, v, truth] += weight
        table = logs(counts)
    return belief, {k: math.exp(x) for k, x in table.items() if len(k) == 3}


def fitted(found_: DataFrame, rounds: int = ROUNDS) -> SpanModel:
    """The model of a table of candidates (`spans`)."""
    spark = found_.sparkSession
    cells = stored(
        found_.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes", "s.digits")
        .agg(F.count(F.lit(1)).cast("double").alias("n")),
        "vote-cells",
    )
    patterns = [(r.kind, tuple(r.votes), r.n) for r in
                cells.groupBy("kind", "votes").agg(F.sum("n").alias("n")).orderBy("kind", "votes").collect()]
    if not patterns:
        return SpanModel()
    belief, reliability = chances(patterns, rounds)
    truth = spark.createDataFrame(
        [(k, list(v), p) for (k, v, _), p in zip(patterns, belief)], "kind int, votes array<int>, p double"
    )
    imagined = spark.createDataFrame(
        [(k, [v] * len(LABELERS), n, PRIOR, float(v > 0)) for k in range(len(KINDS)) for v in (-1, 0, 1) for n in (8, 11, 15)],
        "kind int, votes array<int>, digits int, n double, p double",
    )
    both = cells.join(F.broadcast(truth), ["kind", "votes"]).unionByName(imagined).select(
        array_to_vector(_features(F.col("kind"), F.col("votes"), F.col("digits"))).alias("features"),
        F.explode(F.array(
            F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("p")).alias("weight")),
            F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("p"))).alias("weight")),
        )).alias("of"),
    ).select("features", "of.*")
    fit = LogisticRegression(weightCol="weight", regParam=1e-4, standardization=False, maxIter=50).fit(
        stored(both.select("label", "weight", vector_to_array("features").alias("features")).coalesce(1), "span-cells")
        .select("label", "weight", array_to_vector("features").alias("features"))
    )
    return SpanModel(reliability, tuple(float(w) for w in fit.coefficients), float(fit.intercept))


# --- result spans ---------------------------------------------------------------


def annotated(df: DataFrame, model: SpanModel | None = None, text: str = "text", add: float = ADD) -> DataFrame:
    """(doc, base, spans): rows as structs, their strict spans, and all their spans, each
    sorted by start and kind as (start, kind, end)."""
    model = model or fitted(candidates(df.select(F.col(f"`{text}`").alias("text"))))
    slim = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    rows = candidates(df, text).select(
        "doc", "spans", F.array_sort(F.transform(F.filter("spans", lambda s: s["base"]), slim)).alias("base")
    )

    def likely(s: Column) -> Column:
        clear = ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return ~s["base"] & (model.probability(s["kind"], s["votes"], s["digits"]) >= add) & clear

    def apart(kept: Column, s: Column) -> Column:
        clash = F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"]))
        return F.when(clash, kept).otherwise(F.concat(kept, F.array(s)))

    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    extra = F.aggregate(F.array_sort(F.transform(F.filter("spans", likely), slim)), none, apart)
    return rows.select("doc", "base", F.array_sort(F.concat("base", extra)).alias("spans"))


def spelled(spans: Column | str) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def redacted(text: Column, spans: Column | str) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans
    the first names the whole stretch."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        out = F.concat(state["out"], F.array(gap, F.element_at(names, s["kind"] + 1)))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(fresh, out).otherwise(state["out"]).alias("out"))

    done = F.aggregate(
        spans, begin, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text)))
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
