"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yardstar.llm.common import numbered

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    """Words of a text (maximal runs without ASCII white space); 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(docs: DataFrame) -> Column:
    """128 bits of hash of a whole row: rows that share it are equal in every column.

    Columns that hold maps are hashed as JSON, for maps have no hash of their own.
    """
    columns = []
    for field in docs.schema.fields:
        c = F.col(f"`{field.name.replace('`', '``')}`")
        has_map = "map<" in field.dataType.simpleString()
        columns.append(F.when(c.isNotNull(), F.to_json(F.struct(c.alias("v")))) if has_map else c)
    nulls = F.concat(*(c.isNull().cast("string") for c in columns))  # a hash passes over NULLs
    return F.struct(F.xxhash64(nulls, *columns).alias("h1"), F.xxhash64(F.lit(1), nulls, *columns).alias("h2"))


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: Sequence[int] = (5, 2, 1), most_epochs: int = 3
) -> DataFrame:
    """``(source, source_size, rows, target)``: each source's share of all words.

    Sources ordered by code point, NULL last, weigh ``weights`` in turn. No
    target exceeds ``most_epochs`` times its source's size; what is cut off is
    shared by weight among the others until none is above. That is the level at
    which the sources, sorted by size per weight, stop being capped: a source
    is capped if even the level left over by all smaller ones reaches its cap.

    Works on one row per source: only the sums of sources meet in one task.
    All targets are 0 if there are no words.
    """
    per = sizes.groupBy(source).agg(F.sum(size).alias("source_size"), F.count("*").alias("n_rows"))
    order = Window.orderBy(F.col(source).asc_nulls_last())
    rank = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), rank + 1)
    per = per.select("*", weight.cast("long").alias("_w"))
    everything = Window.partitionBy()
    ratio = F.col("source_size") / F.col("_w")
    before = Window.orderBy(ratio.asc(), F.col(source).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        "*",
        F.sum("source_size").over(everything).alias("_all"),
        F.sum("_w").over(everything).alias("_all_w"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("_smaller"),
        F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_smaller_w"),
    )
    # Words per weight if all smaller sources are capped and this one and all larger ones are not.
    level = (F.col("_all") - most_epochs * F.col("_smaller")) / (F.col("_all_w") - F.col("_smaller_w"))
    per = per.select("*", level.alias("_level"))
    open_ = F.col("_level") * F.col("_w") < most_epochs * F.col("source_size")
    first_open = F.min_by("_level", F.when(open_, F.struct(ratio, F.coalesce(F.col(source), F.lit("")))))
    per = per.select("*", first_open.over(everything).alias("_final"))
    cap = (most_epochs * F.col("source_size")).cast("double")
    target = F.coalesce(F.least(cap, F.col("_final") * F.col("_w")), cap)
    return per.select(
        source, "source_size", "n_rows", F.when(F.col("_all") > 0, target).otherwise(0.0).alias("target")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[int] = (5, 2, 1),
    most_epochs: int = 3,
    seed: int = 20240501,
    bucket_rows: int = 8_192,
) -> DataFrame:
    """Every row of ``docs`` with the number of its words that the mix takes.

    Each row draws a hash-random key. Within a source the rows are dealt into
    ranges of that key, so many that a range holds about ``bucket_rows`` rows;
    a range's offset is the prefix sum of the ranges before it, and a running
    sum inside the range completes it. A source's budget is its target rounded
    to whole words: all rows are taken for the whole epochs that it holds, and
    one more time as long as the prefix sum stays below the rest. The row at
    the cut is taken with its first words only, so that each budget is met
    exactly.

    Returns ``id_col, source_col, size, source_size, target, taken`` and
    ``row_key``, a hash of the whole row by which ``take`` finds it. NULL text has size 0; a NULL source is a source of its own.
    Keys hash the id and the seed alone, so reruns agree; rows without an id
    draw by ``row_key``, so that many of them spread over the ranges like any
    others. Rows that agree in id and size come in the order of ``row_key``;
    those of one id share a range. Other columns are left out:
    join them back by it. An empty table gives no rows.
    """
    sized = docs.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).alias("_source"),
        word_count(text_col).alias("size"),
        row_key(docs).alias("row_key"),
    )
    targets = source_targets(sized, "_source", "size", weights, most_epochs)
    plan = targets.select(
        F.col("_source").alias("_of"),
        "source_size",
        "target",
        F.round("target").cast("long").alias("_budget"),
        F.ceil(F.col("n_rows") / bucket_rows).alias("_ranges"),
    )
    nameless = F.concat_ws(":", F.lit(""), F.col("row_key.h1").cast("string"), F.col("row_key.h2").cast("string"))
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), nameless)))
    keyed = sized.join(plan, F.col("_source").eqNullSafe(F.col("_of"))).select(
        "_id",
        "_source",
        "size",
        "row_key",
        "source_size",
        "target",
        "_budget",
        draw.alias("_key"),
        # The key is uniform: equal ranges of its first digits hold about equally many rows.
        F.floor(F.conv(F.substring(draw, 1, 7), 16, 10).cast("double") / 16**7 * F.col("_ranges")).alias("_range"),
    )
    sums = keyed.groupBy("_source", "_range").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("_source").alias("_o_source"),
        F.col("_range").alias("_o_range"),
        F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_offset"),
    )
    inside = (
        Window.partitionBy("_source", "_range")
        .orderBy("_key", "_id", "size", "row_key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = keyed.select("*", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("_before")).join(
        offsets, F.col("_source").eqNullSafe(F.col("_o_source")) & (F.col("_range") == F.col("_o_range"))
    )
    whole = F.expr("if(source_size > 0, _budget div source_size, 0L)")
    rest = F.col("_budget") - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_offset") - F.col("_before")))
    return placed.select(
        F.col("_id").alias(id_col),
        F.col("_source").alias(source_col),
        "size",
        "source_size",
        "target",
        (F.col("size") * whole + part).cast("long").alias("taken"),
        "row_key",
    )


def take(docs: DataFrame, mixed: DataFrame, text_col: str = "text", n_chars_col: str = "n_chars") -> DataFrame:
    """The mixed corpus: the rows of ``docs``, once for each time the mix of just these rows takes them.

    A row taken in part comes with the text up to the end of its last word
    taken and with the length of that text; rows of which nothing is taken go.
    Rows are found by ``row_key``, so ids may repeat or be NULL. Of rows equal
    in every column one stands for all, and comes for each of them. The columns
    are those of ``docs``.
    """
    wanted = mixed.where("taken > 0").groupBy("row_key").agg(F.first("size").alias("size"), F.collect_list("taken").alias("_all"))
    repeated = mixed.groupBy("row_key").count().where("count > 1").select("row_key")
    columns, schema = docs.columns, docs.schema
    docs, number = numbered(docs)
    docs = docs.select("*", row_key(docs).alias("_key"))
    if not repeated.isEmpty():
        repeated = repeated.select(F.col("row_key").alias("_repeated"))
        several = docs.join(repeated, F.col("_key") == F.col("_repeated"), "left_semi").dropDuplicates(["_key"])
        docs = docs.join(repeated, F.col("_key") == F.col("_repeated"), "left_anti").unionByName(several)
    text = F.col(number[text_col])
    epochs = F.expr("sequence(1L, (taken + size - 1) div size)")
    left = F.expr("least(size, taken - (epoch - 1) * size)")
    rows = (
        docs.join(wanted, F.col("_key") == F.col("row_key"))
        .select("*", F.explode("_all").alias("taken"))
        .select("*", F.explode(epochs).alias("epoch"))
        .select("*", left.alias("left"))
    )
    # A word and the white space behind it; white space at the start is a piece of its own.
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])", -1)
    n_pieces = F.col("left") + text.rlike(r"^[\x20\x09-\x0D]").cast("int")
    cut = F.rtrim(F.array_join(F.slice(pieces, 1, n_pieces.cast("int")), ""), F.lit(" \t\n\x0b\x0c\r"))
    in_part = F.col("left") < F.col("size")
    out = {c: F.col(n) for c, n in number.items()}
    out[text_col] = F.when(in_part, cut).otherwise(text)
    if n_chars_col in out:
        n_chars = F.when(in_part, F.length(out[text_col])).otherwise(out[n_chars_col])
        out[n_chars_col] = n_chars.cast(schema[n_chars_col].dataType)
    return rows.select(*(out[c].alias(c) for c in columns))
