"""Jump consistent hashing: stable keys to shards without a ring table."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from beatline.llm.columns import digest_of

# Fixed value: the multiplier of the published generator, as its upper and lower 32 bits.
_UPPER, _LOWER = 0x27BB2EE6, 0x87B0B0FD
_MASK = 0xFFFFFFFF


def _next_key(high: Column, low: Column) -> tuple[Column, Column]:
    """``key * multiplier + 1`` modulo 2^64 on two halves of 32 bits; no product leaves 63 bits, so ANSI mode is fine."""
    by_lower = low * F.lit(_LOWER & 0xFFFF)
    by_upper = low * F.lit(_LOWER >> 16)
    total = by_lower + by_upper.bitwiseAND(F.lit(0xFFFF)) * F.lit(1 << 16) + F.lit(1)
    carry = F.shiftright(total, 32) + F.shiftright(by_upper, 16)
    crossed = low * F.lit(_UPPER) + (high * F.lit(_LOWER & 0xFFFF))
    shifted = (high * F.lit(_LOWER >> 16)).bitwiseAND(F.lit(0xFFFF)) * F.lit(1 << 16)
    return (carry + crossed + shifted).bitwiseAND(F.lit(_MASK)), total.bitwiseAND(F.lit(_MASK))


def jump_shard(key: Column, shards: int) -> Column:
    """Shard from 0 to ``shards - 1`` of a 64-bit key, as the published algorithm has it.

    A key jumps forward through the shard counts at which it would have moved; its shard is the last one below
    ``shards``.  One more shard therefore takes keys only into itself, 1 in ``shards + 1`` of them.  A key makes
    about ``ln(shards)`` jumps and never more than ``shards``.  A NULL key counts as 0.
    """
    if shards < 1:
        raise ValueError("there must be at least one shard")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(F.lit(_MASK)).alias("low"),
        F.lit(-1).cast("long").alias("at"),
        F.lit(0).cast("long").alias("to"),
    )

    def jump(state: Column, _: Column) -> Column:
        high, low = _next_key(state["high"], state["low"])
        # the upper 31 bits of the key give the jump
        step = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + F.lit(1)).cast("double")
        moved = F.struct(
            high.alias("high"),
            low.alias("low"),
            state["to"].alias("at"),
            ((state["to"] + F.lit(1)).cast("double") * step).cast("long").alias("to"),
        )
        return F.when(state["to"] < F.lit(shards), moved).otherwise(state)

    steps = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(steps, start, jump, lambda state: state["at"]).cast("int")


def number_in_shards(df: DataFrame, shard: str, *order: Column, digits: int = 2, slot: str = "slot") -> DataFrame:
    """Add ``slot``, numbers from 0 without gaps in each shard; a column of that name is replaced.

    Rows are numbered by a digest of ``order``.  A shard is cut into ``16 ** digits`` pieces by the first digits of
    the digest, so its rows spread over as many tasks; the pieces' row counts, ``shards * 16 ** digits`` at most,
    say where each begins.  Rows equal in all of ``order`` share a digest and take consecutive numbers in any order.
    """
    piece, digest, begin = "__piece", "__digest", "__begin"
    with_digest = df.drop(slot).withColumn(digest, digest_of(*order))
    cut = with_digest.withColumn(piece, F.substring(digest, 1, digits))
    counts = cut.groupBy(shard, piece).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(shard).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(shard, piece, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias(begin))
    inside = Window.partitionBy(shard, piece).orderBy(digest, *order)
    numbered = cut.withColumn(slot, F.row_number().over(inside).cast("long") - F.lit(1))
    joined = numbered.join(begins, [shard, piece])
    return joined.withColumn(slot, F.col(slot) + F.col(begin)).drop(piece, digest, begin)


def shard_rows(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", digits: int = 2) -> DataFrame:
    """All rows with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    The law is ``key``: the key and the number of shards decide, whatever the other rows are, and ``grown_shard`` is the
    shard with one shard more.  ``size`` is the text's UTF-8 bytes plus 8.  A NULL text has the size 8 and the checksum of
    an empty one; a NULL key goes where 0 goes; rows with one key share their shard and have slots of their own.
    An empty table gives an empty one.  Columns of these six names are replaced.
    """
    measured = (
        df.withColumn("size", (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("long"))
        .withColumn("text_crc32", F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")))
        .withColumn("law", F.lit("key"))
        .withColumn("shard", jump_shard(F.col(key), shards))
        .withColumn("grown_shard", jump_shard(F.col(key), shards + 1))
    )
    return number_in_shards(measured, "shard", F.col(key), F.col("text_crc32"), digits=digits)
