"""DuckDB SQL for the queries that SQL can express; every constant is written out."""

STATEMENTS: dict[str, str] = {}

STATEMENTS["op10_mix_sources"] = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
        source_size * 3.0::DOUBLE AS most
    FROM totals
), levels AS (
    SELECT *, ((sum(source_size) OVER ())::DOUBLE
        - coalesce(sum(most) OVER (ORDER BY most / weight, encode(source) NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(weight) OVER (ORDER BY most / weight, encode(source) NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), targets AS (
    SELECT source, source_size, least(most, max(level) OVER () * weight) AS target,
        ('0x' || substr(md5('mix/' || coalesce('s' || source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift
    FROM levels
), ranked AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, t.shift,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
        row_number() OVER (PARTITION BY s.source
            ORDER BY lpad(length(bin(s.size))::VARCHAR, 2, '0') || substr(bin(s.size), 1, 3),
                md5(coalesce(s.doc_id::VARCHAR, '')), s.doc_id NULLS FIRST, s.size)::DOUBLE AS rank
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
    (least(floor(rank * rate + shift) - floor((rank - 1) * rate + shift), ceil(rate)) * size)::BIGINT AS taken
FROM ranked
"""

STATEMENTS["op9_benchmark_passages"] = r"""
WITH document_words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), item_places AS (
    SELECT item_id, words, least(10, len(words)) AS width, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS place
    FROM item_words WHERE len(words) > 0
), item_windows AS (
    SELECT DISTINCT item_id, width, array_to_string(words[place:place + width - 1], ' ') AS string FROM item_places
), places AS (
    SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS place
    FROM document_words, (SELECT DISTINCT width FROM item_windows) WHERE len(words) >= width
), windows AS (
    SELECT doc_id, width, place, array_to_string(words[place:place + width - 1], ' ') AS string FROM places
), hits AS (
    SELECT w.doc_id, w.place, w.width, i.item_id FROM windows w JOIN item_windows i USING (width, string)
), hit_words AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(place, place + width)) AS word FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM document_words d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

STATEMENTS["op13_grammar_runs"] = r"""
WITH crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS entry
), split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        xor(list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda digit: ascii(digit)::BIGINT)),
            lambda c, b: xor(entry[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS code
    FROM documents, crc_table
), placed AS (
    SELECT doc_id, words, len(words) AS n, code, (code // 10) % greatest(len(words), 1) AS a FROM split
), bent AS (
    SELECT doc_id, CASE WHEN code % 10 = 0 AND n > 0 THEN list_transform(range(n),
        lambda i: words[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (code // 10) % 8)) END + 1])
        ELSE words END AS words
    FROM placed
), word_rows AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i, len(words) AS n FROM bent
), same AS (
    SELECT x.doc_id, y.i - x.i AS period, y.i AS k
    FROM word_rows x JOIN word_rows y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 4 <= x.n
), islands AS (
    SELECT doc_id, period, min(k) - period AS start, max(k) + 1 AS stop
    FROM (SELECT *, k - row_number() OVER (PARTITION BY doc_id, period ORDER BY k) AS island FROM same)
    GROUP BY doc_id, period, island
    HAVING max(k) + 1 - min(k) + period >= greatest(6, 4 * period)
), runs AS (
    SELECT * FROM islands r WHERE NOT EXISTS (
        SELECT 1 FROM islands s WHERE s.doc_id = r.doc_id AND s.period < r.period AND s.start <= r.start AND s.stop >= r.stop)
), summed AS (
    SELECT doc_id, count(*) AS n_runs,
        string_agg(start || ',' || (stop - start) || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id
), best AS (
    SELECT doc_id, start, stop - start AS length, period FROM runs
    QUALIFY row_number() OVER (PARTITION BY doc_id
        ORDER BY ((stop - start)::DECIMAL(18, 0) * 1000000000000 // period) DESC, start, period) = 1
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, stop)) AS i FROM runs
), left_words AS (
    SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS words
    FROM word_rows w ANTI JOIN dropped d ON w.doc_id = d.doc_id AND w.i = d.i GROUP BY w.doc_id
)
SELECT b.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
    period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(l.words, '')) AS collapsed_sha256
FROM bent b LEFT JOIN summed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN left_words l USING (doc_id)
"""

STATEMENTS["op11_vantage_point_search"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AND vec_id IS NOT NULL
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.v, c.v),
        lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
    FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank, vec_id, score FROM pairs
)
SELECT * FROM ranked WHERE rank <= 10
"""


def _clusters(rounds: int = 10) -> str:
    """Lloyd's rounds written out one after the other."""
    steps = [
        """kept AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), components AS MATERIALIZED (
    SELECT vec_id, generate_subscripts(v, 1) AS d, unnest(v) AS x FROM kept
), centroids0 AS MATERIALIZED (
    SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1)::INT AS cluster, v FROM kept
    ORDER BY sha256('3:' || vec_id) LIMIT 8
)"""
    ]
    for turn in range(rounds + 1):
        steps.append(
            f"""assigned{turn} AS MATERIALIZED (
    SELECT vec_id, k.v, c.cluster,
        list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
    FROM kept k, centroids{turn} c
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, c.cluster) = 1
)"""
        )
        if turn < rounds:
            steps.append(
                f"""means{turn} AS (
    SELECT cluster, list(mean ORDER BY d) AS v FROM (
        SELECT cluster, d, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS mean
        FROM assigned{turn} JOIN components USING (vec_id) GROUP BY cluster, d)
    GROUP BY cluster
), centroids{turn + 1} AS MATERIALIZED (
    SELECT cluster, coalesce(m.v::BIGINT[], c.v) AS v FROM centroids{turn} c LEFT JOIN means{turn} m USING (cluster)
)"""
            )
    return (
        "WITH "
        + ", ".join(steps)
        + f"""
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM assigned{rounds} JOIN centroids{rounds} c USING (cluster)
"""
    )


STATEMENTS["op12_heap_clusters"] = _clusters()
