"""Mixing sources to target weights by systematic sampling."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from beatline.llm.columns import digest_of, on_plain_names

WEIGHTS = (5, 2, 1)


def source_targets(
    sizes: DataFrame, source: str, weights: Sequence[int] = WEIGHTS, most: float = 3.0, total: str = "source_size"
) -> DataFrame:
    """Each source's target, from one row per source with its ``total`` size.

    Sources by code point, NULL last, take the weights in turn and share the sum of all sizes by them.  A target stops
    at ``most`` times its source's size and the excess is shared again by weight until none is above: with the sources
    in order of the level at which they are full, the common level is the largest that any prefix of full ones leaves.
    Sources are few, so one task orders them.  No source at all gives no row; sizes of 0 give targets of 0.
    """
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), turn + 1).cast("double")
    full = sizes.withColumn("__weight", weight).withColumn("__most", F.col(total) * F.lit(most))
    by_level = Window.orderBy(F.col("__most") / F.col("__weight"), F.col(source).asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum(total).over(whole) - F.coalesce(F.sum("__most").over(before), F.lit(0.0))
    levels = full.withColumn("__level", left / F.sum("__weight").over(after))
    target = F.least(F.col("__most"), F.max("__level").over(whole) * F.col("__weight"))
    return levels.withColumn("target", target).drop("__weight", "__most", "__level")


def mix(
    df: DataFrame,
    size: Column,
    source: str = "source",
    order: Sequence[str] = ("doc_id", "text"),
    weights: Sequence[int] = WEIGHTS,
    most: float = 3.0,
    seed: str = "mix",
    digits: int = 1,
) -> DataFrame:
    """All rows with ``size``, ``source_size``, ``target`` and ``copies``, how often the mix takes the row.

    Every row of a source expects ``target / source_size`` copies.  The prefix sum of these, from one random offset of the
    source (a digest of ``seed`` and its name), is taken over the rows in order of size class and then of a digest, and a
    row is taken once for each integer that its step crosses.  Each size class so gets its share of the copies, which
    keeps the taken words near the target.  A size class holds sizes with the same three leading bits.

    A source is cut into pieces by size class and the digest's first digits.  Pieces are counted first; a row's rank is its
    number in the piece plus the rows of the pieces before it, so no source is ever in one task, and ranks are whole numbers.
    Equal runs give equal copies; of rows equal in all of ``order`` any may be the one taken.  A NULL source is a source;
    an empty table gives an empty one.  Columns of the four names are replaced.
    """
    known = (F.col(c) for c in order)
    bits = F.bin(F.col("size"))
    cut = (
        df.drop("source_size", "target", "copies")
        .withColumn("size", size.cast("long"))
        .withColumn("__name", F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("")))
        .withColumn("__class", F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(bits, 1, 3)))
        .withColumn("__digest", digest_of(F.col(order[0])))
        .withColumn("__piece", F.concat("__class", F.substring("__digest", 1, digits)))
    )
    pieces = cut.groupBy("__name", "__piece").agg(
        F.count(F.lit(1)).alias("__rows"), F.sum("size").alias("__size"), F.first(source).alias("__source")
    )
    sources = pieces.groupBy("__name").agg(F.sum("__size").alias("source_size"), F.first("__source").alias("__source"))
    targets = source_targets(sources, "__source", weights, most)
    before = Window.partitionBy("__name").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    begins = pieces.select("__name", "__piece", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__begin"))
    known_pieces = begins.join(targets.drop("__source"), "__name")
    inside = Window.partitionBy("__name", "__piece").orderBy("__digest", *known)
    ranked = cut.withColumn("__rank", F.row_number().over(inside)).join(known_pieces, ["__name", "__piece"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    digits_of = F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.col("__name"))), 1, 8)
    offset = F.conv(digits_of, 16, 10).cast("double") / F.lit(float(1 << 32))
    rank = F.col("__begin") + F.col("__rank")

    def crossed(n: Column) -> Column:
        return F.floor(n.cast("double") * rate + offset)

    # rounding must not push a row over its most
    copies = F.least(crossed(rank) - crossed(rank - 1), F.ceil(rate)).cast("int")
    inner = ("__name", "__class", "__digest", "__piece", "__rank", "__begin")
    return ranked.withColumn("copies", copies).drop(*inner)


def mixed_rows(
    documents: DataFrame, size: Callable[[Column], Column], text: str = "text", key: str = "doc_id", source: str = "source", **settings
) -> DataFrame:
    """Each document as often as the mix takes it, with the columns it had; ``size`` is measured on the text."""

    def emitted(plain: DataFrame, text_name: str, key_name: str, source_name: str) -> DataFrame:
        mixed = mix(plain, size(F.col(text_name)), source_name, (key_name, text_name), **settings)
        return mixed.where(F.col("copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))

    return on_plain_names(documents, emitted, text, key, source)
