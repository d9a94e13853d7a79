"""Text preparation: prefix, sentence lines, tokens, n-grams, id sequences."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Special ids, the label mask and the two length limits.
PAD, EOS, UNK = 0, 1, 2
FIRST_WORD_ID = 3
IGNORED_LABEL = -100
MAX_INPUT, MAX_TARGET = 512, 40
SUMMARY_PREFIX = "summarize: "

_BLANK = "[ \\t\\n\\r\\f]"


def with_prefix(text: Column, prefix: str = SUMMARY_PREFIX) -> Column:
    return F.concat(F.lit(prefix), text)


def sentence_lines(text: Column) -> Column:
    """Stripped text with one sentence per line."""
    stripped = F.regexp_replace(text, f"^{_BLANK}+|{_BLANK}+$", "")
    return F.regexp_replace(stripped, f"([.!?]){_BLANK}+", "$1\n")


def words(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def ngrams(tokens: Column, n: int) -> Column:
    if n == 1:
        return tokens
    grams = F.transform(
        F.sequence(F.lit(1), F.size(tokens) - (n - 1)),
        lambda i: F.concat_ws(" ", F.slice(tokens, i, n)),
    )
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def truncate(ids: Column, limit: int) -> Column:
    return F.slice(ids, 1, limit)


def pad(ids: Column, limit: int, pad_id: int = PAD) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(limit) - F.size(ids)))


def attention_mask(ids: Column, limit: int) -> Column:
    """Ones over the unpadded ids, zeros up to the limit."""
    return F.concat(
        F.array_repeat(F.lit(1), F.size(ids)),
        F.array_repeat(F.lit(0), F.lit(limit) - F.size(ids)),
    )


def mask_padding(ids: Column, pad_id: int = PAD) -> Column:
    return F.transform(ids, lambda x: F.when(x == pad_id, IGNORED_LABEL).otherwise(x))


def unmask_padding(ids: Column, pad_id: int = PAD) -> Column:
    return F.transform(ids, lambda x: F.when(x == IGNORED_LABEL, pad_id).otherwise(x))


def used_length(ids: Column, pad_id: int = PAD) -> Column:
    """Number of ids that are not padding."""
    return F.size(F.filter(ids, lambda x: x != pad_id))
