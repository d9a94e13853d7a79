"""Hash draws, flags, names, calendar parts and map helpers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Accepted spellings of a switch.
SWITCH_ON = ("true", "1", "yes")
STRICT_TRUE = ("y", "yes", "t", "true", "on", "1")
STRICT_FALSE = ("n", "no", "f", "false", "off", "0")

DEFAULT_SPLITS = (("train", 0.70), ("val", 0.15), ("test", 0.15))


def key_text(key: Sequence[str], seed: object = None) -> Column:
    """Key columns as one string; nulls are skipped, so no row loses its draw."""
    parts = [F.col(k).cast("string") for k in key]
    if seed is not None:
        parts.insert(0, F.lit(str(seed)))
    if len(parts) == 1:
        return F.coalesce(parts[0], F.lit(""))
    return F.concat_ws("|", *parts)


def key_digest(key: Sequence[str], seed: object = None) -> Column:
    """Hex digest of the key; its first 8 digits are the draw of the row."""
    return F.md5(key_text(key, seed))


def unit_draw(key: Sequence[str], seed: object = None) -> Column:
    """Uniform draw in [0, 1) that depends on the key alone."""
    head = F.substring(key_digest(key, seed), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(2**32))


def digest_edge(edge: float) -> str:
    """Text such that `digest < text` says the same as `draw < edge`.

    Comparing the digits spares the conversion of every digest to a number.
    """
    first = math.ceil(edge * 2**32)
    return f"{first:08x}" if first < 2**32 else "g"


def split_label(digest: Column, splits: Sequence[tuple[str, float]] = DEFAULT_SPLITS) -> Column:
    """Range predicates on the draw of a digest; the last split takes what is left."""
    edge, label = 0.0, None
    for name, share in splits[:-1]:
        edge = round(edge + share, 12)
        hit = digest < F.lit(digest_edge(edge))
        label = F.when(hit, name) if label is None else label.when(hit, name)
    last = F.lit(splits[-1][0])
    return last if label is None else label.otherwise(last)


def in_split(
    digest: Column, split: str, splits: Sequence[tuple[str, float]] = DEFAULT_SPLITS
) -> Column:
    """Whether the draw of a digest falls into one split."""
    names = [name for name, _ in splits]
    edges = [0.0]
    for _, share in splits:
        edges.append(round(edges[-1] + share, 12))
    at = names.index(split)
    tests = []
    if at > 0:
        tests.append(digest >= F.lit(digest_edge(edges[at])))
    if at < len(names) - 1:
        tests.append(digest < F.lit(digest_edge(edges[at + 1])))
    return tests[0] & tests[1] if len(tests) == 2 else tests[0] if tests else F.lit(True)


def switch(value: Column) -> Column:
    """True for an accepted 'on' spelling, false for anything else, null included."""
    return F.coalesce(F.lower(F.trim(value)).isin(*SWITCH_ON), F.lit(False))


def strict_bool(value: Column, on_error: str = "raise") -> Column:
    """Boolean of a known spelling; unknown text raises, or is null with on_error='null'."""
    text = F.lower(F.trim(value))
    if on_error == "null":
        unknown = F.lit(None).cast("boolean")
    else:
        unknown = F.raise_error(F.concat(F.lit("not a boolean: "), F.coalesce(value, F.lit("null"))))
    return (
        F.when(text.isin(*STRICT_TRUE), True)
        .when(text.isin(*STRICT_FALSE), False)
        .otherwise(unknown.cast("boolean"))
    )


def known_or_error(value: Column, allowed: Sequence[str], what: str = "value") -> Column:
    """The value itself when it is a known one, an error otherwise."""
    problem = F.concat(F.lit(f"unknown {what}: "), F.coalesce(value.cast("string"), F.lit("null")))
    return F.when(value.isin(*allowed), value).otherwise(F.raise_error(problem).cast("string"))


def name_contains(name: Column, needle: str = "t5") -> Column:
    return F.lower(name).contains(needle.lower())


def version_id(name: Column, version: Column) -> Column:
    return F.concat_ws(":", name, version.cast("string"))


def version_parts(identifier: Column) -> Column:
    """Struct(name, version) of 'name:version'; the last colon separates."""
    return F.struct(
        F.regexp_extract(identifier, r"^(.*):([^:]*)$", 1).alias("name"),
        F.regexp_extract(identifier, r"^(.*):([^:]*)$", 2).alias("version"),
    )


def checkpoint_name(epoch: Column, loss: Column) -> Column:
    """File name of a training checkpoint; epoch -1 stands for 'before training'."""
    return F.concat(
        F.lit("model-checkpoint-epoch"), epoch.cast("string"),
        F.lit("-loss"), loss.cast("string"), F.lit(".pt"),
    )


def checkpoint_parts(name: Column) -> Column:
    pattern = r"^model-checkpoint-epoch(-?\d+)-loss(-?[0-9.eE+-]+)\.pt$"
    return F.struct(
        F.regexp_extract(name, pattern, 1).cast("int").alias("epoch"),
        F.regexp_extract(name, pattern, 2).cast("double").alias("loss"),
    )


def calendar_parts(ts: Column, prefix: str) -> list[Column]:
    """Weekday (Monday = 0), month, monthday, hour, minute, second."""
    makers = {
        "weekday": F.weekday, "month": F.month, "monthday": F.dayofmonth,
        "hour": F.hour, "minute": F.minute, "second": F.second,
    }
    return [make(ts).alias(f"{prefix}_{part}") for part, make in makers.items()]


def megabytes(size: Column) -> Column:
    return size / F.lit(1024.0 * 1024.0)


def percent4(share: Column) -> Column:
    """A share as a percentage with four decimals."""
    return F.round(share * 100.0, 4)


def merge_maps(base: Column, update: Column) -> Column:
    """All keys of both maps; the update wins on keys present in both."""
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(update, k))
    return F.map_concat(kept, update)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))
