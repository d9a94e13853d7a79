"""Vocabulary, id encoding and decoding as joins over blocks of texts.

Texts are dealt into blocks by their key, and a block joins each of its distinct tokens
once, however many texts hold it. Texts move once and in whole; the tokens of a block are
replaced beside the names that the block has found.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions import text as tx
from .lookup import lookup
from .position import ordered_position


def postings(df: DataFrame, key: Sequence[str], lists: Mapping[str, Column], kind: str) -> DataFrame:
    """(key, out, value, at): per row and array of `lists` its distinct values with their places.

    Arrays hold `kind` ('string' or 'int'). Null values have no posting; a row without any
    keeps its key with nulls.
    """
    rows = df.select(*key, *[values.alias(f"_l{i}") for i, values in enumerate(lists.values())])
    fields = [rows.schema[k] for k in key]
    made = T.StructType(fields).add("out", "string").add("value", T.StringType() if kind == "string" else T.IntegerType()).add("at", T.ArrayType(T.IntegerType()))
    width, names = len(key), list(lists)
    item = pa.string() if kind == "string" else pa.int32()

    def spread(batches):
        for batch in batches:
            source, outs, values, places = [], [], [], []
            for r in range(batch.num_rows):
                before = len(source)
                for i, out in enumerate(names):
                    found: dict = {}
                    for place, value in enumerate(batch.column(width + i)[r].as_py() or ()):
                        found.setdefault(value, []).append(place)
                    found.pop(None, None)
                    source += [r] * len(found)
                    outs += [out] * len(found)
                    values += found.keys()
                    places += found.values()
                if len(source) == before:
                    for column, blank in ((source, r), (outs, None), (values, None), (places, None)):
                        column.append(blank)
            kept = [batch.column(i).take(pa.array(source, pa.int32())) for i in range(width)]
            new = [pa.array(outs, pa.string()), pa.array(values, item), pa.array(places, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*kept, *new], names=made.names)

    return rows.mapInArrow(spread, made)


#: Blocks that keys are dealt into; a task holds the texts and the names of one block at a time.
BLOCKS = 1024


def replaced(
    df: DataFrame,
    key: Sequence[str],
    lists: Mapping[str, Column],
    names: DataFrame,
    default: int | None = None,
    blocks: int = BLOCKS,
) -> DataFrame:
    """Key plus per entry of `lists` the array of its elements' names, in their order.

    `lists` are arrays of numbers, or texts whose words are parted by one space; `names` has
    two columns, a unique element and its name. An element without a name gets the
    default, if there is one, or has no place. Null elements have no place. Rows of one key
    become one row: by place, then by name.
    """
    block = F.pmod(F.xxhash64(*key), F.lit(blocks)).cast("int").alias("_block")
    outs = [f"_l{i}" for i in range(len(lists))]
    rows = df.select(block, *key, *[column.alias(out) for out, column in zip(outs, lists.values())])
    rows = rows.repartition("_block")
    value, name = names.schema.fields
    made = T.StructType([rows.schema[k] for k in key] + [T.StructField(out, T.ArrayType(name.dataType)) for out in lists])
    width = len(key)

    def one(column):
        """The column in one piece."""
        return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)

    def elements(column):
        """All elements of the rows, and how many each row has."""
        if not pa.types.is_string(column.type):
            return pc.list_flatten(column), pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        words = pc.split_pattern(column, " ")
        n = pc.fill_null(pc.list_value_length(words), 0).to_numpy()
        empty = pc.fill_null(pc.equal(column, ""), False).to_numpy(zero_copy_only=False)
        flat = pc.list_flatten(words)
        return flat.filter(pc.not_equal(flat, "")), np.where(empty, 0, n)

    def distinct(batches):
        """(_block, value) of the distinct elements; the rows of a block follow each other."""
        block, held = None, []

        def found():
            values = pc.drop_null(pc.unique(pa.chunked_array(held)))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(values), block, "int32")), values], names=["_block", value.name])

        for batch in batches:
            at = batch.column(0).to_numpy()
            columns = [(flat, np.cumsum([0, *n])) for flat, n in (elements(batch.column(1 + width + i)) for i in range(len(outs)))]
            for start, end in pairwise([0, *(np.flatnonzero(np.diff(at)) + 1), len(at)]):
                if start < end and at[start] != block:
                    if held:
                        yield found()
                    block, held = at[start], []
                held += [pc.unique(flat[ends[start]:ends[end]]) for flat, ends in columns]
        if held:
            yield found()

    def fill(texts, known):
        """One block: its rows with names for elements."""
        texts, known = texts.combine_chunks(), known.combine_chunks()
        keys = [*zip(*(texts.column(1 + i).to_pylist() for i in range(width)))]
        group: dict = {}
        of = np.array([group.setdefault(k, len(group)) for k in keys], "int64")
        first = pa.array(np.unique(of, return_index=True)[1])
        columns = [texts.column(1 + i).take(first) for i in range(width)]
        for i in range(len(outs)):
            flat, n = elements(one(texts.column(1 + width + i)))
            named = one(known.column(2)).take(pc.index_in(flat, value_set=one(known.column(1)), skip_nulls=True))
            kept = pc.is_valid(named if default is None else flat).to_numpy(zero_copy_only=False)
            if default is not None:
                named = pc.fill_null(named, default)
            sizes = n
            if len(group) < len(keys) or not kept.all():
                row = np.repeat(np.arange(len(n)), n)
                place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                named, row, place = named.filter(pa.array(kept)), row[kept], place[kept]
                if len(group) < len(keys):
                    spread = pa.table({"group": of[row], "at": place, "name": named})
                    named = named.take(pc.sort_indices(spread, sort_keys=[(c, "ascending") for c in spread.column_names]))
                sizes = np.bincount(of[row], minlength=len(group))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("int32"))
            columns.append(pa.ListArray.from_arrays(offsets, named))
        return pa.Table.from_arrays(columns, names=made.names)

    # All columns go along, so that the rows are read from the same shuffle as below.
    sought = rows.sortWithinPartitions("_block").mapInArrow(distinct, T.StructType().add("_block", T.IntegerType()).add(value))
    known = lookup(sought, names, [value.name]).select("_block", value.name, name.name)
    return rows.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(fill, made)


def token_counts(df: DataFrame, text: str) -> DataFrame:
    """Token frequencies; counted per task before the shuffle."""
    tokens = df.select(F.explode(tx.words(F.col(text))).alias("token"))
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def build_vocabulary(df: DataFrame, text: str, max_size: int | None = None) -> DataFrame:
    """(token, n, id): ids follow the special ones in order of count, then token.

    Every token is kept unless the caller states a size.
    """
    counts = token_counts(df, text)
    order = [F.desc("n"), F.asc("token")]
    if max_size is None:
        ranked = ordered_position(counts, order, "_rank")
    else:
        top = counts.orderBy(*order).limit(max_size)
        ranked = top.withColumn("_rank", F.row_number().over(W.orderBy(*order)))
    first = tx.FIRST_WORD_ID - 1
    return ranked.select("token", "n", (F.col("_rank") + first).cast("int").alias("id"))


def token_ids(
    df: DataFrame,
    key: Sequence[str],
    columns: Mapping[str, tuple[str, int | None]],
    vocabulary: DataFrame,
    append_eos: bool = True,
) -> DataFrame:
    """Key plus one id array per entry of `columns` (output -> (text column, limit)).

    Texts are cut to their limit before they move, so a key never holds more ids than the
    limits allow; without a limit (None) a key holds its own text. Unknown tokens become `UNK`.
    """
    room = 1 if append_eos else 0

    def tokens(column: str, limit: int | None) -> Column:
        words = tx.words(F.col(column))
        return words if limit is None else tx.truncate(words, limit - room)

    texts = {out: F.array_join(tokens(c, n), " ") for out, (c, n) in columns.items()}
    coded = replaced(df, key, texts, vocabulary.select("token", "id"), tx.UNK)
    if not append_eos:
        return coded
    return coded.select(*key, *[F.concat(out, F.array(F.lit(tx.EOS))).alias(out) for out in columns])


def drop_null_pairs(df: DataFrame, text: str, summary: str) -> DataFrame:
    """Keep a pair only when both of its sides are present."""
    return df.na.drop(subset=[text, summary])


def encode_pairs(
    df: DataFrame,
    key: Sequence[str],
    text: str,
    summary: str,
    vocabulary: DataFrame,
    max_input: int = tx.MAX_INPUT,
    max_target: int = tx.MAX_TARGET,
    prefix: str = "",
    pad_to_max: bool = True,
) -> DataFrame:
    """Null-pair filter, prefix, ids, truncation, padding, mask and label masking."""
    pairs = drop_null_pairs(df, text, summary).select(
        *key,
        tx.with_prefix(F.col(text), prefix).alias("_text"),
        F.col(summary).alias("_summary"),
    )
    coded = token_ids(
        pairs, key,
        {"input_ids": ("_text", max_input), "labels": ("_summary", max_target)},
        vocabulary,
    )
    ids, labels = F.col("input_ids"), F.col("labels")
    if not pad_to_max:
        return coded.select(
            *key, ids, F.array_repeat(F.lit(1), F.size(ids)).alias("attention_mask"), labels
        )
    return coded.select(
        *key,
        tx.pad(ids, max_input).alias("input_ids"),
        tx.attention_mask(ids, max_input).alias("attention_mask"),
        tx.mask_padding(tx.pad(labels, max_target)).alias("labels"),
    )


def decode_ids(
    df: DataFrame,
    key: Sequence[str],
    ids: str,
    vocabulary: DataFrame,
    out: str = "text",
) -> DataFrame:
    """Text of an id array: masked labels become padding, special ids are skipped."""
    whole = tx.unmask_padding(F.col(ids)).cast("array<int>")
    words = vocabulary.where(F.col("id") >= tx.FIRST_WORD_ID).select("id", "token")
    named = replaced(df, key, {"_words": whole}, words)
    return named.select(*key, F.array_join("_words", " ").alias(out))
