"""The registered queries of this package and their SQL oracles."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import ann, bpe, chat, decontam, importance, langid, ngram_join, packing, phrases, sharding, shared, substrings, toxicity, warc

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def use_root(spark: SparkSession) -> None:
    """Let workers that inherit nothing of the driver's import path find this package."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def _query(fn):
    """Register ``fn`` under its name."""

    def run(spark: SparkSession, directory: str) -> DataFrame:
        use_root(spark)
        return fn(spark, directory)

    QUERIES[fn.__name__] = run
    return fn


def _read(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


@_query
def op2_rendezvous_shards(spark: SparkSession, directory: str) -> DataFrame:
    """Every document's shard among eight of equal weight, and among nine."""
    return sharding.sharded(_read(spark, directory, "documents"), "doc_id", "text", [1.0] * 8, [1.0] * 9)


@_query
def op4_warc_revisits(spark: SparkSession, directory: str) -> DataFrame:
    """Every page written to an archive, repeats as revisits, and read back from it."""
    path = shared.new_folder(spark, "warc")
    warc.write_warc(warc.page_records(_read(spark, directory, "pages")), path)
    read = warc.read_warc(spark, path).where(F.col("record_type").isin("response", "revisit"))
    full = F.col("record_type") == "response"
    return read.select(
        F.col("record_id").cast("long").alias("page_id"),
        F.when(full, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(full, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


ORACLES["op4_warc_revisits"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages
), m AS (SELECT d, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN last > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last > page_id THEN last END AS refers_to
FROM p LEFT JOIN m ON p.d = m.d
"""


@_query
def op7_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    """Documents that hold at least three quarters of a benchmark item's five-word shingles."""
    return decontam.contained(_read(spark, directory, "documents"), _read(spark, directory, "benchmark"))


_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"""
_SHINGLES = """SELECT {id}, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s
  FROM {words}"""

ORACLES["op7_decontamination"] = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
d AS (SELECT DISTINCT * FROM ({_SHINGLES.format(id="doc_id", words="dw")})),
i AS (SELECT DISTINCT * FROM ({_SHINGLES.format(id="item_id", words="iw")})),
n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id)
SELECT doc_id, item_id, count(*) / max(n)::DOUBLE AS containment, max(n) AS n_shingles
FROM d JOIN i USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) / max(n)::DOUBLE >= 0.75
"""


@_query
def op8_language_id(spark: SparkSession, directory: str) -> DataFrame:
    """The language of every document, learned from the labelled ones that are not held out."""
    documents = _read(spark, directory, "documents")
    return langid.predict(documents, langid.fit(documents))


@_query
def op3_chat_repair(spark: SparkSession, directory: str) -> DataFrame:
    """Every turn with its repaired role and its part of the rendered conversation."""
    return chat.repaired(_read(spark, directory, "conversations"))


@_query
def op10_toxic_spans(spark: SparkSession, directory: str) -> DataFrame:
    """Toxicity of every document from the marginals of a field learned on the labels not held out."""
    documents = _read(spark, directory, "documents")
    field = toxicity.fit(documents, _read(spark, directory, "labels"))
    return toxicity.tag(documents, field)


@_query
def op1_minimum_slack_packing(spark: SparkSession, directory: str) -> DataFrame:
    """Every document's tokens packed into sequences of 1024."""
    return packing.packed(_read(spark, directory, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op6_posting_list_neighbours(spark: SparkSession, directory: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one, searched among all."""
    vectors = _read(spark, directory, "embeddings")
    return ann.search(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@_query
def op9_ngram_jaccard_join(spark: SparkSession, directory: str) -> DataFrame:
    """Every document's component of links of Jaccard 0.75 or more on five-word shingles."""
    return ngram_join.joined(_read(spark, directory, "documents"))


ORACLES["op9_ngram_jaccard_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT * FROM ({_SHINGLES.format(id="doc_id", words="w")})),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT doc_id, doc_id AS low FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.low)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.low) AS component_id
FROM documents d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""


@_query
def op5_suffix_array_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """What is left of every document without 100-byte strings that the corpus holds earlier."""
    return substrings.removed(_read(spark, directory, "documents"))


@_query
def op11_bpe_round_trip(spark: SparkSession, directory: str) -> DataFrame:
    """Digests of every document's ids and of the text that they decode to."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    ids = bpe.encoded(_read(spark, directory, "documents").select("doc_id", "text"), vocabulary)
    return bpe.decoded(ids, vocabulary).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@_query
def op12_collocations(spark: SparkSession, directory: str) -> DataFrame:
    """Each language's 2000 most cohesive phrases of two to four words."""
    return phrases.collocations(_read(spark, directory, "documents"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op12_collocations"] = f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS m)
), f AS (SELECT lang, m, phrase, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m >= 2 AND f >= 30),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
s AS (
  SELECT k.lang, k.phrase, k.k, k.f AS a, x.f AS l, y.f AS r, (2000000 * k.f - (2000000 * k.f) % (x.f + y.f)) / (x.f + y.f) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1 : k.k], ' ')
  JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k + 1 :], ' ')
), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (
  SELECT c.lang, c.f, array_to_string(c.w[i : i + m2 - 1], ' ') AS phrase
  FROM c, (SELECT unnest([2, 3]) AS m2), (SELECT unnest([1, 2, 3]) AS i) WHERE m2 < m AND i + m2 - 1 <= m
), h AS (SELECT lang, phrase, max(f) AS f FROM i GROUP BY ALL),
o AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
  FROM b JOIN t ON t.lang = b.lang LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE coalesce(100 * h.f < 80 * a, true)
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM o WHERE rank <= 2000
"""


@_query
def op13_importance_resampling(spark: SparkSession, directory: str) -> DataFrame:
    """Every document's weight towards the benchmark's features, and the quarter that is drawn."""
    return importance.resampled(_read(spark, directory, "documents"), _read(spark, directory, "benchmark"))


ORACLES["op13_importance_resampling"] = f"""
WITH d AS (
  SELECT 0 AS kind, doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT 1, item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), f AS (
  SELECT kind, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM d
), crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS e
), u AS (
  SELECT feature, xor(list_reduce(list_transform(range(octet_length(encode(feature))),
    lambda i: ('0x' || substr(hex(encode(feature)), 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, e[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM f), crc
), n AS (SELECT bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t FROM f JOIN u USING (feature) GROUP BY bucket),
a AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s, coalesce(sum(t), 0)::DOUBLE AS t FROM n),
g AS (SELECT bucket, floor(1000 * ln(((n.t + 1) * (a.s + 10000)) / ((n.s + 1) * (a.t + 10000))))::BIGINT AS gain FROM n, a),
v AS (SELECT doc_id, count(*) AS n_features, floor(sum(gain) / count(*)::DOUBLE)::BIGINT AS weight FROM f JOIN u USING (feature) JOIN g USING (bucket) WHERE kind = 0 GROUP BY doc_id),
z AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN v USING (doc_id) WHERE kind = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () * 25 // 100 AS drawn FROM z
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM r
"""
