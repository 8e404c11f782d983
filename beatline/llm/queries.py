"""Registered queries; each takes the session and a folder of tables and runs over whole tables."""

import hashlib
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from beatline.llm import centroids, chosen_path, decontamination, extraction, fingerprints, languages, mixing, periodic, scoring, secrets, sharding, toxicity, vantage
from beatline.llm.columns import id_remainder, space_words
from beatline.session import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_order_minhash(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    following = {"next_text": "text", "next_signature": "signature"}
    paired = fingerprints.with_next(documents, "doc_id", following, ["text"], fingerprints.fingerprints)
    n_chars = F.char_length("text").cast("long")
    paired = paired.withColumn("n_chars", n_chars)
    paired = paired.withColumn("edited", fingerprints.edited(F.col("text"), F.col("n_chars"), F.col("next_text")))
    both = fingerprints.fingerprints(paired, "edited", "edited_signature")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.written(F.col("signature")).alias("fingerprint"),
        fingerprints.written(F.col("edited_signature")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        fingerprints.likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )


@_query
def op2_hyperdimensional_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    profiles = languages.learn(documents.where(~held_out))
    return languages.identify(documents, profiles, keep=("doc_id", held_out.alias("held_out")))


@_query
def op3_jump_shards(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_rows(documents, 24).drop("text")


@_query
def op4_toxic_segments(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(documents, table(spark, sf_dir, "labels"), lambda key: id_remainder(key, 4) != 2)
    return scored.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "significance",
        F.size("segments").alias("n_segments"),
    )


@_query
def op5_secret_ownership(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))

    def spans(kind: str):
        return F.filter("base", lambda s: s["kind"] == kind)

    live = F.filter("all_spans", lambda s: s["live"])
    return found.select(
        "doc_id",
        *(F.size(spans(kind)).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secrets.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.written(F.col("all_spans")).alias("spans"),
        F.size(live).cast("long").alias("n_live"),
        (F.size("all_spans") - F.size(live)).cast("long").alias("n_copied"),
    )


@_query
def op6_main_text(spark, sf_dir):
    return extraction.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@_query
def op7_recurrent_scores(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    scored = scoring.score(documents, ~held_out)
    names = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return scored.select("doc_id", held_out.alias("held_out"), *names)


@_query
def op8_chosen_path_join(spark, sf_dir):
    return chosen_path.join(table(spark, sf_dir, "documents")).drop("digest", "class_digest")


@_query
def op9_benchmark_passages(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_passages(documents, table(spark, sf_dir, "benchmark"))
    n_hit = decontamination.hit_words()
    ids = F.concat_ws(",", F.sort_array(F.transform("hit_items", lambda item: item.cast("string"))))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@_query
def op10_mix_sources(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    sized = documents.select("doc_id", "source", space_words(F.col("text")).alias("size"))
    # counted in one pass over the texts; the mix reads the narrow table twice
    mixed = mixing.mix(staged(sized, "sizes"), F.col("size"), order=("doc_id", "size"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


@_query
def op11_vantage_point_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vantage.nearest(vectors, F.col("vec_id") % 100 == 0, k=10, factor=1.0)


@_query
def op12_heap_clusters(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    written = F.concat(F.lit("3:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    found = centroids.cluster(vectors, k=8, rounds=10, order=F.sha2(written.cast("binary"), 256))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]

    def of_cluster(values: list, kind: str):
        # eight values at most
        return F.array(*map(F.lit, values)).cast(f"array<{kind}>")[F.col("cluster")]

    return found.vectors.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster(found.inertia, "bigint").alias("cluster_inertia"),
        F.lit(sum(found.inertia)).cast("bigint").alias("inertia"),
        of_cluster(digests, "string").alias("centroid_sha256"),
    )


def _with_planted_runs(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Words of a document of which one in ten, by its ID, repeats from a place on."""
    code, n = zlib.crc32(str("" if doc_id is None else doc_id).encode()), len(words)
    if code % 10 or not n:
        return words
    rest = code // 10
    first = rest % n
    period = 1 + (n - first) // (3 + rest % 8)
    return words[:first] + [words[first + (i - first) % period] for i in range(first, n)]


@_query
def op13_grammar_runs(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.detect(documents, change=_with_planted_runs, key="doc_id").withColumn("best", periodic.strongest())
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.expr("1000 * best.length div best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
