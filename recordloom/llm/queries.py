"""The registered queries of the text operators, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import (
    alignment,
    byte_bpe,
    exact_dedup,
    merkle,
    mixing,
    ngram_join,
    personal_data,
    projected_search,
    quality_ranker,
    quality_rules,
    secret_scan,
    sharding,
    token_counts,
)
from recordloom.llm.texts import read, text_of, word_count
from recordloom.plans.registry import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

SHARDS = [f"shard-{n:02d}" for n in range(16)]


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql.strip()
        return function

    return register


def readable(size, text_col: str = "text"):
    """Quality weight of a text: 1 at a mean word length of 6, less the further it is from that."""
    mean = F.length(text_of(text_col)) / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(0.1), 1 - F.abs(mean - 6) / 10)


OP1_SQL = r"""
WITH base AS (
    SELECT doc_id, coalesce('0' || source, '1') AS place,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        length(coalesce(text, '')) AS chars,
        (CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 1)
            / 4503599627370496.0::DOUBLE AS u
    FROM documents
), keyed AS (
    SELECT doc_id, place, size,
        -ln(u) / greatest(0.1::DOUBLE, 1 - abs(chars::DOUBLE / greatest(size, 1) - 6) / 10) AS k
    FROM base
), sources AS (
    SELECT place, CAST(sum(size) AS BIGINT) AS source_size,
        CASE (row_number() OVER (ORDER BY place) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM keyed GROUP BY place
), levels AS (
    SELECT *, 3 * source_size AS most,
        CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, place
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS remaining,
        CAST(sum(weight) OVER (ORDER BY 3 * source_size / weight, place
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS weight_left,
        row_number() OVER (ORDER BY 3 * source_size / weight, place) AS step
    FROM sources
), first_open AS (
    SELECT remaining, weight_left, step FROM levels
    WHERE most * weight_left >= remaining * weight ORDER BY step LIMIT 1
), targets AS (
    SELECT l.place, l.source_size, CASE WHEN l.step < f.step THEN l.most::DOUBLE
        ELSE least(l.most::DOUBLE, (l.weight * f.remaining)::DOUBLE / f.weight_left::DOUBLE) END AS target
    FROM levels l CROSS JOIN first_open f
), planned AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(least(floor(target / source_size), 3) AS BIGINT) ELSE 0 END AS epochs
    FROM targets
), running AS (
    SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
        sum(k.size) OVER (PARTITION BY k.place ORDER BY k.k, k.doc_id, k.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
    FROM keyed k JOIN planned p ON k.place = p.place
)
SELECT doc_id, size, source_size, target,
    CAST((epochs + CASE WHEN 2 * until - size <= 2 * rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM running
"""


@query(OP1_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("_size", word_count("text"))
    mixed = mixing.mix(docs, F.col("_size"), readable(F.col("_size")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = r"""
WITH bare AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, CAST(count(*) OVER (PARTITION BY t) AS BIGINT) AS group_size,
    row_number() OVER best = 1 AS kept, sha256(t) AS text_sha256
FROM bare
WINDOW best AS (PARTITION BY t ORDER BY n DESC, doc_id)
"""


@query(OP6_SQL)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH RECURSIVE shards AS (
    SELECT list(CAST('0x' || substr(md5('start:' || name), 1, 8) AS BIGINT) % 2039 ORDER BY name) AS starts,
        list(CAST('0x' || substr(md5('step:' || name), 1, 8) AS BIGINT) % 2038 + 1 ORDER BY name) AS steps
    FROM (SELECT 'shard-' || lpad(CAST(i AS VARCHAR), 2, '0') AS name FROM range(16) t(i))
), turns(turn, free, slot) AS (
    SELECT -1, list_transform(range(2039), lambda i: true), CAST(-1 AS BIGINT)
    UNION ALL
    SELECT turn, list_transform(free, lambda f, i: f AND i <> slot + 1), slot
    FROM (
        SELECT turn + 1 AS turn, free, list_filter(
            list_transform(range(2039), lambda j: (starts[(turn + 1) % 16 + 1] + j * steps[(turn + 1) % 16 + 1]) % 2039),
            lambda s: free[s + 1])[1] AS slot
        FROM turns, shards WHERE turn < 2038
    )
), filled AS (
    SELECT slot, turn FROM turns WHERE turn >= 0
)
SELECT d.doc_id, CAST(f.slot AS INTEGER) AS slot, 'shard-' || lpad(CAST(f.turn % 16 AS VARCHAR), 2, '0') AS shard
FROM documents d
JOIN filled f ON f.slot = CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 2039
"""


@query(OP9_SQL)
def op9_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, F.col("doc_id"), SHARDS)


OVER = 2048


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(read(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > OVER)


def span_text(spans: str) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(text, ",")


def only(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def digest(chosen: Column) -> Column:
    """SHA-256 of spans written out."""
    text = F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.sha2(F.array_join(text, ","), 256)


def of_kind(spans: str, kind: str) -> Column:
    return F.size(only(spans, kind)).cast("bigint")


@query()
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[of_kind("spans", kind).alias(f"n_{kind}") for kind in secret_scan.PATTERN_KINDS],
        digest(F.filter("spans", lambda s: s["kind"].isin(*secret_scan.PATTERN_KINDS))).alias("base_sha256"),
        span_text("spans").alias("spans"),
    )


@query()
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = byte_bpe.round_trip(read(spark, sf_dir, "documents"))
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(read(spark, sf_dir, "documents"))


@query()
def op10_quality_ranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    ranker = quality_ranker.fit(docs, read(spark, sf_dir, "labels"))
    return quality_ranker.score(docs, ranker).select(
        "doc_id",
        (quality_ranker.fold() == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality_ranker.THRESHOLD).cast("int").alias("predicted"),
    )


OP4_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS gram FROM places
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
    FROM shingles a JOIN shingles b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * common >= 85 * (p.n + q.n - common)
), reached(a, b) AS (
    SELECT x, y FROM links UNION SELECT a, y FROM reached JOIN links ON x = b
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles,
    coalesce((SELECT least(min(b), d.doc_id) FROM reached WHERE a = d.doc_id), d.doc_id) AS component_id,
    (SELECT count(*) FROM links WHERE x = d.doc_id) AS n_links
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""


@query(OP4_SQL)
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = ngram_join.link_counts(read(spark, sf_dir, "documents"))
    return linked.select("doc_id", "n_shingles", "component_id", "n_links")


@query()
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = personal_data.scan(docs, personal_data.fit(docs))
    found = found.withColumn("strict", F.filter("spans", lambda s: s["strict"]))
    return found.select(
        "doc_id",
        *[of_kind("strict", kind).alias(f"n_{kind}") for kind in personal_data.KINDS],
        digest(F.concat(*[only("strict", kind) for kind in personal_data.KINDS])).alias("base_sha256"),
        span_text("spans").alias("spans"),
    )


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_statistics(read(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH RECURSIVE bits AS (
    SELECT doc_id, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: list_concat([ascii(c)::BIGINT], list_transform(range(8), lambda i: -1::BIGINT))))),
        lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END) AS crc
    FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), hashed AS (
    SELECT d.doc_id, coalesce('1' || source, '0') AS tree,
        coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
        sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        coalesce(xor(crc, 4294967295) % 5 = 0, false) AS tampered,
        CASE WHEN tampered THEN sha256(head || coalesce(strlen(text) || ':' ||
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) ELSE leaf END AS given
    FROM documents d LEFT JOIN bits USING (doc_id)
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
        count(*) OVER (PARTITION BY tree) AS n FROM hashed
), nodes(tree, level, idx, n, digest) AS (
    SELECT tree, 0, rank, n, leaf FROM leaves
    UNION ALL
    SELECT tree, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
    FROM nodes WHERE n > 1 GROUP BY tree, level, n, idx // 16
), groups AS (
    SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS rank, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops(level, idx, n, digest) AS (
    SELECT 0, rank, n, subroot FROM groups
    UNION ALL
    SELECT level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
    FROM tops WHERE n > 1 GROUP BY level, n, idx // 16
), steps AS (
    SELECT l.tree, l.rank, s.level AS step, s.idx AS place, s.digest, s.idx = l.rank // (16 ** s.level)::BIGINT AS own
    FROM leaves l JOIN nodes s ON s.tree = l.tree AND s.n > 1 AND s.idx // 16 = l.rank // (16 ** (s.level + 1))::BIGINT
    UNION ALL
    SELECT l.tree, l.rank, 100 + s.level, s.idx, s.digest, s.idx = g.rank // (16 ** s.level)::BIGINT
    FROM leaves l JOIN groups g ON g.tree = l.tree JOIN tops s ON s.n > 1 AND s.idx // 16 = g.rank // (16 ** (s.level + 1))::BIGINT
), ways AS (
    SELECT tree, rank, row_number() OVER (PARTITION BY tree, rank ORDER BY step) AS turn,
        coalesce(string_agg(digest, '' ORDER BY place) FILTER (WHERE place < mine), '') AS before,
        coalesce(string_agg(digest, '' ORDER BY place) FILTER (WHERE place > mine), '') AS after
    FROM (SELECT *, max(place) FILTER (WHERE own) OVER (PARTITION BY tree, rank, step) AS mine FROM steps)
    GROUP BY tree, rank, step
), folds(tree, rank, turn, digest) AS (
    SELECT tree, rank, 0, given FROM leaves
    UNION ALL
    SELECT f.tree, f.rank, w.turn, sha256(w.before || f.digest || w.after)
    FROM folds f JOIN ways w ON w.tree = f.tree AND w.rank = f.rank AND w.turn = f.turn + 1
), folded AS (
    SELECT tree, rank, max_by(digest, turn) AS folded_root FROM folds GROUP BY tree, rank
), proofs AS (
    SELECT tree, rank, sha256(string_agg(before || after, '' ORDER BY turn)) AS proof FROM ways GROUP BY tree, rank
)
SELECT l.doc_id, l.leaf, g.subroot, t.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
    f.folded_root, f.folded_root = t.digest AS verified
FROM leaves l JOIN groups g ON g.tree = l.tree JOIN tops t ON t.n = 1
JOIN folded f ON f.tree = l.tree AND f.rank = l.rank LEFT JOIN proofs p ON p.tree = l.tree AND p.rank = l.rank
"""


@query(OP13_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read(spark, sf_dir, "documents"))


@query()
def op12_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected_search.nearest(read(spark, sf_dir, "embeddings"))
