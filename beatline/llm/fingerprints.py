"""Order MinHash: document fingerprints that follow the edit distance."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from beatline.llm.columns import let

SKETCHES = 64
TUPLE = 2
WORDS = 3
# A token is a run of at most 16 characters other than spaces and signs, or one sign, or one character of the scripts from
# Thai to Lao and from the CJK radicals to the Hangul syllables, which need no spaces.
TOKEN = r"[^\s\p{P}\p{S}\u0E00-\u0EFF\u2E80-\uD7FF]{1,16}+|\S"
# Places of k-mers take the lower bits of a packed value; no text that Spark can hold has more tokens.
_PLACE_BITS = 27
_PLACES = (1 << _PLACE_BITS) - 1
_RANKS = 1 << (63 - _PLACE_BITS)


def _packed(hash_: Column, place: Column) -> Column:
    """The upper bits of a hash as a number from 0, and a place below them; sorts by the one, then by the other."""
    return F.shiftleft(F.shiftrightunsigned(hash_, _PLACE_BITS + 1), _PLACE_BITS).bitwiseOR(place.cast("long"))


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(_PLACES)).cast("int")


def signature(text: Column, sketches: int = SKETCHES, size: int = TUPLE, words: int = WORDS) -> Column:
    """``sketches`` hashes, each of ``size`` k-mers in their text order; k-mers are ``words`` consecutive tokens.

    Equal k-mers are numbered by occurrence, and (k-mer, number) pairs are put in a random order, on a circle.  Sketch ``j`` takes
    the ``size`` pairs that come first from the point ``j / sketches`` of the circle on, which are the minimal ones under the
    order turned by that much; it puts them back in text order and hashes their k-mers.  Two texts agree in a sketch about as
    often as both keep the chosen k-mers and their order.  A text of fewer tokens than ``words`` has one k-mer, of
    all its tokens; fewer k-mers than ``size`` are all taken; no token at all (also NULL) gives zeros.
    """
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    # no element after the last k-mer's first token; position 0 of a slice would be an error for an empty text
    return let(F.transform(tokens, lambda token: F.xxhash64(token)), lambda h: _of_tokens(h, sketches, size, words))


def _of_tokens(hashes: Column, sketches: int, size: int, words: int) -> Column:
    n = F.greatest(F.size(hashes) - F.lit(words - 1), F.lit(1))
    first = F.slice(hashes, 1, n)

    def kmer(hash_: Column, i: Column) -> Column:
        return F.xxhash64(hash_, *(F.get(hashes, i + F.lit(k)) for k in range(1, words)))

    return let(F.transform(first, kmer), lambda kmers: _of_kmers(kmers, sketches, size))


def _of_kmers(kmers: Column, sketches: int, size: int) -> Column:
    by_kmer = F.sort_array(F.transform(kmers, _packed))
    none = F.array_repeat(F.lit(0).cast("long"), sketches)
    return F.when(F.size(kmers) == 0, none).otherwise(
        let(by_kmer, lambda sorted_: let(_ranked(sorted_), lambda ranked: _sketches(kmers, ranked, sketches, size)))
    )


def _same(a: Column, b: Column) -> Column:
    return F.shiftright(a, _PLACE_BITS) == F.shiftright(b, _PLACE_BITS)


def _ranked(by_kmer: Column) -> Column:
    """All places in the random order of (k-mer, occurrence number)."""
    places = F.sequence(F.lit(0), F.size(by_kmer) - 1)
    starts = F.filter(places, lambda i: (i == 0) | ~_same(F.get(by_kmer, i), F.get(by_kmer, i - 1)))

    def numbers(runs: Column) -> Column:
        def of_run(start: Column, run: Column) -> Column:
            after = F.coalesce(F.get(runs, run + 1), F.size(by_kmer))
            return F.sequence(F.lit(0), after - start - 1)

        return F.flatten(F.transform(runs, of_run))

    def rank(number: Column, i: Column) -> Column:
        packed = F.get(by_kmer, i)
        return _packed(F.xxhash64(F.shiftright(packed, _PLACE_BITS), number), _place(packed))

    return F.sort_array(let(starts, lambda runs: F.transform(numbers(runs), rank)))


def _sketches(kmers: Column, ranked: Column, sketches: int, size: int) -> Column:
    # anchors stand in the order like k-mers, at a place that no k-mer has
    anchors = F.array(*(F.lit((j * _RANKS // sketches) << _PLACE_BITS | _PLACES) for j in range(sketches)))
    takes = F.sequence(F.lit(0), F.least(F.lit(size), F.size(ranked)) - 1)
    both = F.sort_array(F.concat(ranked, anchors))
    marked = F.transform(both, lambda x, i: F.when(x.bitwiseAND(F.lit(_PLACES)) == F.lit(_PLACES), i))

    def sketch(at: Column, j: Column) -> Column:
        # what stands before the anchor, without the anchors before it
        chosen = F.transform(takes, lambda k: _place(F.get(ranked, (at - j + k) % F.size(ranked))))
        in_order = F.transform(F.sort_array(chosen), lambda place: F.get(kmers, place))
        return F.aggregate(in_order, F.lit(0).cast("long"), lambda total, kmer: F.xxhash64(total, kmer))

    return F.transform(F.filter(marked, lambda at: at.isNotNull()), sketch)


def likeness(a: Column, b: Column) -> Column:
    """Share of the sketches in which two signatures agree, 0 to 1."""
    same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda total, x: total + x) / F.size(a).cast("double")


def written(signature_: Column) -> Column:
    """The signature as 8 hexadecimal digits per sketch."""
    return F.array_join(F.transform(signature_, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def with_next(
    df: DataFrame,
    key: str,
    columns: dict[str, str],
    ties: list[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    range_rows: int = 250,
) -> DataFrame:
    """All rows with ``columns`` (new name to name) of the next row by ``key``; after the last comes the first.

    Rows are cut into ranges of the key, of about ``range_rows`` rows but 65 536 ranges at most, and only ordered inside one.
    Ranges hold equally many rows where the keys are spread evenly within 16 times finer steps; one number for each of these,
    a million at most, is all that is broadcast.
    The first row of each range also stands, as a guest, at the end of the range before, so no row is alone.  ``prepare`` may add
    columns to all rows and guests before they are ordered.  ``ties`` order rows of one key; NULL keys come first.  A single row is followed by itself; an empty table gives an empty one.
    """
    low, high = "__low", "__high"
    value = F.col(key).cast("double")
    span = df.agg(F.min(value).alias(low), F.max(value).alias(high), F.count(F.lit(1)).alias("__n")).first()
    bins = min(65_536, 1 + span["__n"] // range_rows)
    low_value = span[low] if span[low] is not None else 0.0
    width = max((span[high] or 0.0) - low_value, 1.0)
    steps = 16 * bins
    step = F.least(F.floor((value - F.lit(low_value)) / F.lit(width) * F.lit(steps)), F.lit(steps - 1))
    step = F.when(value.isNull(), F.lit(-1)).otherwise(step)
    counts = df.select(step.alias("__step")).groupBy("__step").agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.orderBy("__step").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    before = F.coalesce(F.sum("__n").over(upto), F.lit(0))
    ranges = counts.select("__step", F.floor(before * F.lit(bins) / F.sum("__n").over(whole)).alias("__bin"))
    ranges = ranges.withColumn("__bin", F.dense_rank().over(Window.orderBy("__bin")))
    placed = df.withColumn("__step", step).join(F.broadcast(ranges), "__step").withColumn("__guest", F.lit(False))
    # one key per range: the guests are the rows of these keys, in the range before
    firsts = placed.groupBy("__bin").agg(F.min(F.struct(F.col(key).alias("__key"))).alias("__first"))
    hosts = F.coalesce(F.lag("__bin").over(Window.orderBy("__bin")), F.max("__bin").over(whole))
    firsts = firsts.select(F.col("__bin"), hosts.alias("__host"), F.col("__first.__key").alias("__key"))
    # a range of NULL keys only has a NULL for its first key
    guests = placed.join(F.broadcast(firsts), "__bin").where(F.col(key).eqNullSafe(F.col("__key")))
    guests = guests.withColumn("__guest", F.lit(True)).withColumn("__bin", F.col("__host")).select(*placed.columns)
    order = Window.partitionBy("__bin").orderBy("__guest", F.col(key).asc_nulls_first(), *ties)
    following = prepare(placed.unionByName(guests)).withColumns({new: F.lead(old).over(order) for new, old in columns.items()})
    return following.where(~F.col("__guest")).drop("__step", "__bin", "__guest")


def edited(text: Column, n_chars: Column, following: Column) -> Column:
    """The text with its last quarter, in code points, replaced by as many from the start of another."""
    cut = F.floor(n_chars / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n_chars - cut).cast("int")), F.substring(following, F.lit(1), cut))


def fingerprints(documents: DataFrame, text: str = "text", column: str = "signature", **settings) -> DataFrame:
    """All rows with the signature of the whole text; a column of that name is replaced."""
    return documents.withColumn(column, signature(F.col(text), **settings))
