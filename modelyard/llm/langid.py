"""Language identification by Bayesian fusion of text, markup, address and host evidence.

Text: a naive Bayes model of hashed byte trigrams of letters per language, fitted on a bounded
sample of labelled rows; numbers and symbols count for nothing. Overlapping trigrams and long texts are not independent evidence, so a
text counts as at most `STRENGTH` independent trigrams. An unknown language stands for
all others: it gives every trigram the same chance.

The other evidence is learnt from the whole table by grouped aggregation of what the texts
alone say: how often each declared language and each address suffix goes with a language,
and the mix of languages of every host. Host mixes are smoothed hierarchically: a host
leans on its domain, the domain on its suffix, the suffix on the whole table.

A row is accepted if some known language has a posterior of at least `ACCEPT`.

Cells of (host, declared, text language) are aggregated before the shuffle. The evidence
tables are stored, so they are broadcast only below the session's threshold and otherwise
joined with hot hosts split.

Defined cases: a null or empty text brings no text evidence; a null declaration, address
or host brings none either, and a host without a dot is its own domain; repeated rows get
equal answers; an empty table has none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

UNKNOWN = "und"
LANGUAGES = ("de", "en", "es", "fr")
SAMPLE = 2000  # labelled rows per language that the text model is fitted on
STRENGTH = 60.0
SMOOTH = 0.5  # added to each trigram count
PULL = 20.0  # rows that a level of the host hierarchy weighs against its parent
ACCEPT = 0.5
_BITS = 14
_PIECE = 1 << 18  # bytes of a text counted at a time


# Digits, symbols and controls say nothing about a language; other bytes are letters.
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def trigrams(text: bytes) -> np.ndarray:
    """Counts of hashed byte trigrams of the letters of a text, in lower case and with one
    blank for all that stands between them."""
    counts = np.zeros(1 << _BITS, np.int64)
    data = np.frombuffer(b" ".join(text.lower().translate(_LETTERS).split()), np.uint8)
    for at in range(0, max(0, len(data) - 2), _PIECE):
        part = data[at:at + _PIECE + 2].astype(np.uint32)
        code = (part[:-2] << 16) | (part[1:-1] << 8) | part[2:]
        counts += np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - _BITS), minlength=1 << _BITS)
    return counts


def _counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in rows:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            sums[lang] = sums.get(lang, 0) + trigrams(text or b"")
    for lang, counts in sums.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at)), pa.array(at), pa.array(counts[at])], names=["lang", "gram", "n"]
        )


def text_model(
    df: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id",
    languages: Sequence[str] = LANGUAGES, sample: int = SAMPLE,
) -> np.ndarray:
    """Log chances of every trigram, a row per language, from about `sample` rows of each.

    Rows are drawn by a hash of their key against the share that the language needs.
    """
    labelled = df.select(
        F.col(f"`{label}`").alias("lang"), F.col(f"`{text}`").alias("text"), F.col(f"`{key}`").alias("key")
    ).where(F.col("lang").isin(*languages))
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("key"), F.lit(1_000_003)) / 1_000_003
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample / n))]) if sizes else None
    counts = np.full((len(languages), 1 << _BITS), SMOOTH)
    if sizes:
        drawn = labelled.where(draw <= share[F.col("lang")]).select("lang", "text")
        found = drawn.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        for r in found.collect():  # at most a row per language and trigram bucket
            counts[list(languages).index(r.lang), r.gram] += r.n
    return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def text_scores(text: Column | str, model, strength: float = STRENGTH) -> Column:
    """Log likelihoods of a text by language, the unknown language last."""

    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        table, out = model.value, []
        for value in texts.cast(pa.binary()):
            counts = trigrams(value.as_py() or b"")
            n = counts.sum()
            scale = strength * (1 - math.exp(-n / 3 / strength)) / n if n else 0.0
            used = np.flatnonzero(counts)
            known = table[:, used] @ counts[used].astype(np.float64)
            out.append([*(known * scale).tolist(), -float(n) * scale * _BITS * math.log(2)])
        return pa.array(out, pa.list_(pa.float64()))

    return of(text)


def _counts(rows: DataFrame, by: str, languages: Sequence[str]) -> DataFrame:
    """(by, counts): rows of every language for each value."""
    sums = [F.sum(F.when(F.col("said") == lang, F.col("n")).otherwise(0)).cast("double") for lang in languages]
    return rows.where(F.col(by).isNotNull()).groupBy(by).agg(F.array(*sums).alias("counts"))


def _smoothed(counts: str, parent: Column, pull: float) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, parent, lambda c, p: (c + p * pull) / (total + pull))


def _given(values: DataFrame, by: str, name: str, languages: Sequence[str], totals: list[float]) -> DataFrame:
    """(by, name): log chance of a value given each language."""
    of = F.transform("counts", lambda c, i: F.log((c + 1.0) / (F.array(*[F.lit(t + 2.0) for t in totals])[i])))
    return stored(_counts(values, by, languages).select(by, of.alias(name)), f"given-{by}")


def identified(
    df: DataFrame, model: np.ndarray, text: str = "text", declared: str | None = "lang", host: str | None = "source",
    languages: Sequence[str] = LANGUAGES, carry: Sequence[str] | None = None, pull: float = PULL, accept: float = ACCEPT,
) -> DataFrame:
    """(doc, language, probability, accepted): rows as structs of the `carry` columns."""
    spark, names = df.sparkSession, [*languages, UNKNOWN]
    shared = spark.sparkContext.broadcast(model)
    none = F.lit(None).cast("string")
    address = F.lower(F.col(f"`{host}`").cast("string")) if host else none
    scored = stored(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in (carry or df.columns)]).alias("doc"),
            (F.lower(F.col(f"`{declared}`").cast("string")) if declared else none).alias("declared"),
            address.alias("host"), F.regexp_extract(address, r"([^.]+\.[^.]+)$", 1).alias("domain"),
            F.regexp_extract(address, r"\.([^.]+)$", 1).alias("suffix"),
            text_scores(F.col(f"`{text}`"), shared).alias("scores"),
        ).withColumn("domain", F.when(F.col("domain") != "", F.col("domain")).otherwise(F.col("host")))
        .withColumn("suffix", F.when(F.col("suffix") != "", F.col("suffix"))),
        "language-scores",
    )
    best = F.array_position(F.col("scores"), F.array_max("scores")).cast("int")
    told = F.array_max("scores") > F.array_min("scores")  # a text without letters says no language
    said = F.when(told, F.array(*[F.lit(n) for n in names])[best - 1])
    cells = stored(
        scored.groupBy("host", "domain", "suffix", "declared", said.alias("said")).agg(F.count(F.lit(1)).alias("n")),
        "language-cells",
    )
    spoken = cells.where("said is not null")
    per = {r.said: float(r.n) for r in cells.groupBy("said").agg(F.sum("n").alias("n")).collect()}
    totals = [per.get(n, 0.0) for n in names]
    whole = [(t + 1.0) / (sum(totals) + len(names)) for t in totals]
    overall = F.array(*[F.lit(w) for w in whole])

    suffixes = _counts(cells, "suffix", names).select("suffix", _smoothed("counts", overall, pull).alias("over"))
    domains = (
        _counts(cells, "domain", names)
        .join(cells.groupBy("domain").agg(F.min("suffix").alias("suffix")), "domain").join(suffixes, "suffix", "left")
        .select("domain", _smoothed("counts", F.coalesce("over", overall), pull).alias("over"))
    )
    hosts = stored(
        _counts(cells, "host", names)
        .join(cells.groupBy("host").agg(F.min("domain").alias("domain")), "host").join(domains, "domain", "left")
        .select("host", _smoothed("counts", F.coalesce("over", overall), pull).alias("prior")),
        "host-priors",
    )
    zero = F.array(*[F.lit(0.0)] * len(names))
    fused = (
        scored.join(hosts, "host", "left")
        .join(_given(spoken, "declared", "by_markup", names, totals), "declared", "left")
        .join(_given(spoken, "suffix", "by_suffix", names, totals), "suffix", "left")
    )
    plus = lambda a, b: a + b
    prior = F.transform(F.coalesce("prior", overall), lambda p: F.log(p))
    logs = F.zip_with(
        F.zip_with("scores", prior, plus),
        F.zip_with(F.coalesce("by_markup", zero), F.coalesce("by_suffix", zero), plus), plus,
    )
    top = F.array_max("logs")
    likely = F.transform("logs", lambda x: F.exp(x - top))
    return (
        fused.select("doc", logs.alias("logs")).select("doc", likely.alias("likely"))
        .select("doc", "likely", F.aggregate("likely", F.lit(0.0), plus).alias("sum"),
                F.array_position("likely", F.array_max("likely")).cast("int").alias("at"))
        .select(
            "doc", F.array(*[F.lit(n) for n in names])[F.col("at") - 1].alias("language"),
            (F.array_max("likely") / F.col("sum")).alias("probability"),
        )
        .withColumn("accepted", (F.col("language") != UNKNOWN) & (F.col("probability") >= accept))
    )
