"""Secrets in texts, told apart by how many owners hold the same value."""

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from beatline.session import staged

KINDS = ("assign", "access", "hex", "owned")
# Fixed patterns of the base kinds.
ASSIGN = re.compile(
    r"""(?a)((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST = {"assign": 8, "access": 16}
# Tokens that may be credentials without any context.
TOKEN = re.compile(r"(?a)(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{16,}")
LEAST_ENTROPY = 3.0
MOST_OWNERS, MOST_REPOSITORIES = 1, 3


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base matches, leftmost and without overlap within a kind.

    A match of ``assign`` that is too short still uses up its text.  Runs of hex digits are maximal, and no shorter run
    can begin inside one, so asking for 32 at once gives the same matches as dropping the short ones.
    """
    out = []
    if ":" in text or "=" in text:
        out += [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def entropy(value: str) -> float:
    """Bits per character."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def other_tokens(text: str, known: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Long tokens of letters with digits in no base span, random enough to be a credential.

    Tokens and spans are both in order, so one walk over the two finds what overlaps.
    """
    out, at, reach = [], 0, 0
    for m in TOKEN.finditer(text):
        start, end = m.span()
        while at < len(known) and known[at][1] < end:
            reach = max(reach, known[at][2])
            at += 1
        if reach <= start and any(c.isalpha() for c in m[0]) and entropy(m[0]) >= LEAST_ENTROPY:
            out.append(("owned", start, end, m[0]))
    return out


_CANDIDATE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
_CANDIDATE_SQL = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def _scan(text: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for value in batch.column(text):
            string = value.as_py() or ""
            spans = base_spans(string)
            spans += other_tokens(string, spans)
            # values leave the task as digests only
            found.append(
                [{"kind": k, "start": a, "end": b, "value": hashlib.sha256(v.encode()).hexdigest()} for k, a, b, v in spans]
            )
        kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n not in (text, "candidates")]
        names = [n for n in batch.schema.names if n not in (text, "candidates")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(found, type=pa.list_(_CANDIDATE))], [*names, "candidates"])


def candidates(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``candidates``, base matches and other tokens with the digest of each value, in place of the text."""
    kept = documents.drop("candidates")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != text)
    asked = kept.withColumn("candidates", F.lit(None).cast(_CANDIDATE_SQL))
    return asked.mapInArrow(lambda batches: _scan(text, batches), f"{schema}, candidates {_CANDIDATE_SQL}")


def ownership(found: DataFrame, owner: str, repository: str, text: str) -> DataFrame:
    """Per value, in how many distinct owners and repositories it stands; ``text`` has a digest of each row's text.

    Exact copies of one text count once, with the least owner and repository.  NULL is an owner like any other, but says
    nothing of the repository: there each text counts.  Rows are made distinct by value and text first, in each task before
    the shuffle, and counted by value before the next one, so no task sees all holders of one value at once.
    """
    held = found.select(F.explode("candidates.value").alias("value"), F.col(text).alias("text"), F.col(owner), F.col(repository))
    texts = held.groupBy("value", "text").agg(
        F.min(F.coalesce(F.col(owner).cast("string"), F.lit(""))).alias("owner"),
        F.min(F.col(repository).cast("string")).alias("repository"),
    )
    # a text and a repository never have the same name
    named = F.coalesce(F.concat(F.lit("r"), "repository"), F.concat(F.lit("t"), "text"))
    owners = texts.groupBy("value", "owner").agg(F.count(F.lit(1))).groupBy("value").agg(F.count(F.lit(1)).alias("owners"))
    places = texts.groupBy("value", named.alias("place")).agg(F.count(F.lit(1)))
    return owners.join(places.groupBy("value").agg(F.count(F.lit(1)).alias("repositories")), "value")


def scan(
    documents: DataFrame,
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    most_owners: int = MOST_OWNERS,
    most_repositories: int = MOST_REPOSITORIES,
) -> DataFrame:
    """One row per document: ``base`` spans and ``all_spans``, each (kind, start, end, value digest, owners, repositories, live).

    Base matches always stay.  A token that no base pattern finds is added, as kind ``owned``, when at most ``most_owners``
    owners and ``most_repositories`` repositories in the whole corpus hold its value, where exact copies of a text count
    once: what many hold, or one holds in many places, is a copied example; what one owner holds in few looks like a live
    credential.  ``live`` says the same of base matches.  NULL and empty texts have no spans; rows with one ID are
    scanned each; an empty table gives an empty one.  Spans are in code points, end exclusive.
    """
    digested = documents.withColumn("__text", F.md5(F.col(text).cast("binary")))
    found = staged(candidates(digested, text).withColumn("__row", F.monotonically_increasing_id()), "secrets")
    counts = ownership(found, owner, repository, "__text")
    each = found.select("__row", F.explode("candidates").alias("c")).select("__row", "c.*").join(counts, "value")
    live = (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)
    place = _place("kind").alias("place")
    span = F.struct("start", place, "end", "kind", "value", "owners", "repositories", live.alias("live"))
    kept = each.where((F.col("kind") != "owned") | live)
    by_row = kept.groupBy("__row").agg(F.sort_array(F.collect_list(span)).alias("all_spans"))
    rows = found.drop("candidates", "__text").join(by_row, "__row", "left").drop("__row")
    empty = F.coalesce("all_spans", F.array().cast(by_row.schema["all_spans"].dataType))
    rows = rows.withColumn("all_spans", empty)
    return rows.withColumn("base", F.filter("all_spans", lambda s: s["kind"] != "owned"))


def _place(kind: str) -> Column:
    return F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col(kind))


def written(spans: Column) -> Column:
    """``kind:start:end`` of the spans, with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
