"""The registered queries of the operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingspark.llm import (
    ball_tree, language, licences, merkle, mixing, packing, parity_join, pieces, prefix_trie, resample, shards,
    spot_signatures, url_rules,
)
from filingspark.llm.tables import table
from filingspark.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


@query("op1_spot_signatures")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.fingerprints(table(spark, sf_dir, "documents"))


URL_RULES = [
    url_rules.Rule.of_host("net", "/", "block"),
    url_rules.Rule.of_host("example.net", "/en/", "allow"),
    url_rules.Rule.of_host("example.com", "/de/", "block"),
    url_rules.Rule.of_host("org", "/fr/", "allow"),
    url_rules.Rule("*/login*", "block"),
    url_rules.Rule("*/*.zip", "block"),
    url_rules.Rule("*/*sessionid=*", "block"),
    # the same in the query of a URL without a path, as the SQL has it
    url_rules.Rule("*\\?*/*sessionid=*", "block"),
]


@query(
    "op4_url_rules",
    r"""
    WITH cut AS (
      SELECT page_id, coalesce(substr(url, nullif(strpos(url, '://'), 0) + 3), '') AS rest FROM pages),
    parts AS (
      SELECT page_id, rest,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
        regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query FROM cut),
    judged AS (
      SELECT *, '.' || host || path || query AS whole, CASE
        WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts)
    SELECT page_id, host, path, rule, CASE
      WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
      WHEN rule IS NOT NULL THEN 'allow'
      WHEN starts_with(path, '/login') OR (path <> '' AND regexp_matches(whole, '^[^/]*/.*\.zip$'))
        OR regexp_matches(whole, '^[^/]*/.*sessionid=') THEN 'block'
      ELSE 'allow' END AS verdict FROM judged
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, "url", URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query(
    "op6_ball_tree",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c FROM embeddings
      WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
    s AS (
      SELECT q.vec_id AS query_id, r.vec_id,
        CAST(list_sum(list_transform(range(1, len(q.c) + 1), lambda i: q.c[i] * r.c[i])) AS BIGINT) AS score
      FROM v q JOIN v r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ball_tree.scaled(table(spark, sf_dir, "embeddings"))
    return ball_tree.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


@query(
    "op8_source_schedule",
    r"""
    WITH d AS (
      SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
        md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS h FROM documents),
    s AS (
      SELECT source, CAST(sum(size) AS DOUBLE) AS whole,
        [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
      FROM d GROUP BY source),
    t AS (
      SELECT *, 3 * whole AS cap, row_number() OVER (ORDER BY 3 * whole / w, source NULLS LAST) AS r,
        (sum(whole) OVER () - coalesce(sum(3 * whole) OVER (ORDER BY 3 * whole / w, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
        (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY 3 * whole / w, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM s),
    g AS (
      SELECT source, whole, least(cap, coalesce((SELECT min_by(level, r) FROM t WHERE cap > level * w) * w, cap)) AS target
      FROM t),
    p AS (
      SELECT d.doc_id, d.size, g.whole, g.target, CAST(round(g.target) AS BIGINT) AS wanted,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
    SELECT doc_id, size, CAST(whole AS BIGINT) AS source_size, target, CAST(CASE WHEN size = 0 THEN 0 ELSE
      (wanted // CAST(whole AS BIGINT)) * size
      + greatest(0, least(size, wanted % CAST(whole AS BIGINT) - start)) END AS BIGINT) AS taken FROM p
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_rows(mixing.sized(table(spark, sf_dir, "documents"))).drop("source")


@query("op10_sampled_splitters")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"), 24)


@query("op9_parity_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.components(table(spark, sf_dir, "documents"))


@query("op2_segmented_unigrams")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang", "text"
    )
    model = language.learn(docs.where("not held_out"))
    return language.identify(docs, model, columns=["doc_id", "held_out"])


@query("op3_best_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op5_merkle_audit")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    replicas = merkle.page_replicas(table(spark, sf_dir, "pages"))
    return merkle.audit(replicas, ["a", "b", "c"])


@query("op7_licence_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan(docs, licences.train(docs))


# CRC-32 of the bytes of a text, in SQL: a table of 256 steps, and a fold over the bytes in hex
CRC_SQL = """
    steps AS (
      SELECT list(c ORDER BY b) AS step FROM (
        SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) AS c
        FROM range(256) r(b))),
    crcs AS (
      SELECT feature, xor(list_reduce(
        list_transform(range(0, octet_length(encode(feature))),
          lambda i: CAST('0x' || substr(hex(encode(feature)), 2 * i + 1, 2) AS BIGINT)),
        lambda c, b: xor(c // 256, step[1 + xor(c, b) % 256]), 4294967295::BIGINT), 4294967295) AS crc
      FROM (SELECT DISTINCT feature FROM words) CROSS JOIN steps)"""


@query(
    "op11_resample",
    rf"""
    WITH texts AS (
      SELECT 'd' AS side, row_number() OVER () AS row, doc_id AS id, text FROM documents
      UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark),
    split AS (
      SELECT side, row, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
    words AS (
      SELECT side, row, unnest(list_concat(w,
        list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM split),{CRC_SQL},
    counts AS (
      SELECT b AS bucket, count(side) FILTER (side = 'd') AS s, count(side) FILTER (side = 'b') AS t
      FROM range(10000) r(b) LEFT JOIN (SELECT side, crc % 10000 AS bucket FROM words JOIN crcs USING (feature)) ON b = bucket
      GROUP BY b),
    gains AS (
      SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000)::DOUBLE
        / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain FROM counts),
    weighed AS (
      SELECT row, count(*) AS n, sum(gain) AS total
      FROM words JOIN crcs USING (feature) JOIN gains ON bucket = crc % 10000 WHERE side = 'd' GROUP BY row),
    scored AS (
      SELECT id AS doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features,
        CAST(coalesce((total - ((total % n) + n) % n) // n, 0) AS BIGINT) AS weight,
        CAST('0x' || substr(sha256('7:' || coalesce(CAST(id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
      FROM split LEFT JOIN weighed USING (row) WHERE side = 'd'),
    noised AS (
      SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM scored),
    ranked AS (
      SELECT *, row_number() OVER (ORDER BY n_words >= 20 DESC, score DESC, doc_id NULLS LAST, weight, n_features) AS r,
        (count(*) FILTER (n_words >= 20) OVER ()) * 25 // 100 AS drawn FROM noised)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_features AS BIGINT) AS n_features, weight, score,
      CASE WHEN r <= drawn THEN r END AS rank FROM ranked
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_piece_codec")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"))


@query(
    "op13_prefix_trie",
    rf"""
    WITH t AS (
      SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    words AS (SELECT CAST(conv_id AS VARCHAR) AS feature FROM t),{CRC_SQL},
    r AS (
      SELECT c.conv_id, list_concat(coalesce(b.turns[1:crc % 4], []), c.turns[crc % 4 + 1:]) AS turns
      FROM t c JOIN crcs ON feature = CAST(c.conv_id AS VARCHAR)
      LEFT JOIN t b ON b.conv_id = c.conv_id - ((c.conv_id % 20) + 20) % 20),
    p AS (SELECT conv_id, len(turns) AS whole, d, turns[1:d] AS prefix FROM (
      SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)),
    n AS (
      SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (whole = d), '')) AS ends_sha256,
        CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(prefix[d].text, '[^\x20\x09-\x0D]+')) END AS saved
      FROM p GROUP BY prefix, d),
    c AS (SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
    f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (prefix, d)),
    u AS (
      SELECT prefix[1:a] AS prefix, a AS d, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM f) GROUP BY ALL)
    SELECT f.conv_id, f.d AS depth, o.conv_id AS parent_conv_id, f.n_convs, f.n_children, u.n_leaves,
      CAST(u.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
    FROM f JOIN u USING (prefix, d) LEFT JOIN n o ON o.d = f.d - 1 AND o.prefix = f.prefix[1:f.d - 1]
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
