"""Registered queries of this package, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from comarca.llm import (
    decontamination,
    frames,
    langid,
    mixing,
    piece_encoding,
    quality_zstd,
    simhash_trie,
    source_divergence,
    splitters,
    token_spans,
    toxicity_zstd,
    vector_graph,
    warc_zip,
    whitening,
)
from entries.tables import table

QUERIES = {}
ORACLES = {}


def entry(key, sql=None):
    def add(query):
        QUERIES[key] = query
        if sql:
            ORACLES[key] = sql
        return query

    return add


@entry(
    "op6_mixing",
    """WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(concat_ws('/', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')), '17')) AS o FROM documents),
sources AS (
  SELECT *, 1 + (rank - 1) % 3 AS weight FROM (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM docs GROUP BY source)),
filled AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, sum(weight) OVER () AS weights, count(*) OVER () AS n,
         sum(3 * source_size) OVER by_ratio - 3 * source_size AS used, sum(weight) OVER by_ratio - weight AS gone
  FROM sources WINDOW by_ratio AS (ORDER BY source_size / weight, rank ROWS UNBOUNDED PRECEDING)),
rated AS (
  SELECT *, CAST(total - used AS DOUBLE) / CAST(weights - gone AS DOUBLE) AS rate_here FROM filled),
sized AS (
  SELECT source, source_size, rank, total, least(CAST(3 * source_size AS DOUBLE), coalesce(rate * weight, 3 * source_size)) AS target,
         greatest(1, CAST(ceil(total / (n * 200)) AS BIGINT)) AS block
  FROM rated, (SELECT min_by(rate_here, gone) AS rate FROM rated WHERE rate_here * weight <= 3 * source_size)),
few AS (
  SELECT *, CASE WHEN least(CAST(source_size AS DOUBLE), target) < block * 50 THEN CAST(round(target) AS BIGINT) END AS exact FROM sized),
targets AS (SELECT *, round((total - coalesce(sum(exact) OVER (), 0)) / block) AS seats FROM few),
seated AS (
  SELECT rank, count(*) AS quota FROM (
    SELECT rank, seats, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rank, k) AS seat
    FROM (SELECT *, unnest(range(least(3 * source_size // block, CAST(ceil(target / block) AS BIGINT) * 2 + 8))) AS k
          FROM targets WHERE exact IS NULL))
  WHERE seat <= seats GROUP BY rank),
blocks AS (
  SELECT rank, quota // n + CASE WHEN row_number() OVER (PARTITION BY rank ORDER BY md5(concat_ws('/', rank, no, '17')), no)
            <= quota % n THEN 1 ELSE 0 END AS times, no * block AS start, least((no + 1) * block, source_size) AS upto
  FROM (SELECT rank, block, source_size, coalesce(quota, 0) AS quota, CAST(ceil(source_size / block) AS BIGINT) AS n,
               unnest(range(CAST(ceil(source_size / block) AS BIGINT))) AS no
        FROM targets LEFT JOIN seated USING (rank) WHERE exact IS NULL)
  UNION ALL SELECT rank, exact // source_size + 1, 0, exact % source_size FROM targets WHERE exact IS NOT NULL AND source_size > 0
  UNION ALL SELECT rank, exact // source_size, exact % source_size, source_size FROM targets
  WHERE exact IS NOT NULL AND source_size > 0),
placed AS (
  SELECT doc_id, size, source_size, target, rank, row_number() OVER () AS id,
         sum(size) OVER (PARTITION BY rank ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source)
SELECT p.doc_id, p.size, p.source_size, p.target, CAST(coalesce(sum(b.times * (least(p.upto, b.upto)
       - greatest(p.upto - p.size, b.start))), 0) AS BIGINT) AS taken
FROM placed p LEFT JOIN blocks b ON b.rank = p.rank AND b.start < p.upto AND b.upto > p.upto - p.size
GROUP BY p.id, p.doc_id, p.size, p.source_size, p.target""",
)
def _(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source", "copies", "kept")


@entry("op8_splitters")
def _(spark, sf_dir):
    placed = splitters.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@entry("op10_token_spans")
def _(spark, sf_dir):
    return token_spans.count_tokens(table(spark, sf_dir, "documents"))


@entry(
    "op3_warc_zip",
    """SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN strlen(body) >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(body) >= 100 AND page_id > first THEN first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM (
  SELECT page_id, coalesce(html, '') AS body, sha256(coalesce(html, '')) AS digest FROM pages))""",
)
def _(spark, sf_dir):
    return warc_zip.archive_round_trip(table(spark, sf_dir, "pages"))


@entry("op4_langid")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    remainder = frames.fold(F.col("doc_id"), 4)
    model = langid.fit(docs.where(remainder != 2))
    found = langid.predicted(docs, model, F.col("text"))
    return docs.select(
        "doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), found.alias("found")
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")


@entry("op2_simhash_trie")
def _(spark, sf_dir):
    found = simhash_trie.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_trie.hexadecimal(F.col("bits")).alias("fingerprint"), "component_id")


@entry(
    "op7_decontamination",
    """WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
cut AS (
  SELECT item_id, words, least(len(words), 10) AS length, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i
  FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, length, array_to_string(words[i:i + length - 1], ' ') AS w FROM cut),
places AS (
  SELECT doc_id, words, length, unnest(range(1, len(words) - length + 2)) AS i
  FROM docs, (SELECT DISTINCT length FROM windows)),
hits AS (
  SELECT doc_id, item_id, i, length FROM (SELECT *, array_to_string(words[i:i + length - 1], ' ') AS w FROM places)
  JOIN windows USING (length, w)),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids
  FROM hits GROUP BY doc_id),
hit_words AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + length)) AS p FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN found USING (doc_id) LEFT JOIN hit_words USING (doc_id)""",
)
def _(spark, sf_dir):
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def _scored(spark, sf_dir, operator, parts, held):
    docs = table(spark, sf_dir, "documents")
    remainder = frames.fold(F.col("doc_id"), parts)
    labels = table(spark, sf_dir, "labels")
    model = operator.fit(docs, labels.where(remainder != held))
    return docs.select(
        "doc_id", F.coalesce(remainder == held, F.lit(False)).alias("held_out"),
        model.scores(docs, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= operator.THRESHOLD).cast("int"))


@entry("op1_quality_zstd")
def _(spark, sf_dir):
    return _scored(spark, sf_dir, quality_zstd, 5, 0)


@entry("op9_toxicity_zstd")
def _(spark, sf_dir):
    return _scored(spark, sf_dir, toxicity_zstd, 3, 1)


@entry("op5_vector_graph")
def _(spark, sf_dir):
    return vector_graph.near_vectors(table(spark, sf_dir, "embeddings"))


@entry("op11_piece_chunks")
def _(spark, sf_dir):
    import public_tokenizers

    found = piece_encoding.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@entry(
    "op13_source_divergence",
    """WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
occurring AS (SELECT lang, source, id, unnest(terms) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS times FROM occurring GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
languages AS (SELECT lang, count(*) AS v, sum(times) AS n FROM kept GROUP BY lang),
counts AS (
  SELECT lang, source, term, count(*) AS times FROM occurring SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
sources AS (
  SELECT lang, source, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs)
  LEFT JOIN (SELECT lang, source, sum(times) AS n FROM counts GROUP BY lang, source) USING (lang, source)),
shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.times, 0) AS times,
         1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.times, 0) + 5) // (s.n + 5 * l.v) AS p,
         1 + CAST(1000000000 AS HUGEINT) * (k.times + 5) // (l.n + 5 * l.v) AS q
  FROM sources s JOIN languages l ON l.lang = s.lang JOIN kept k ON k.lang = s.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
differing AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
values AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN differing d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE times > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM values)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= 50""",
)
def _(spark, sf_dir):
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


@entry("op12_qd_whitening")
def _(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
