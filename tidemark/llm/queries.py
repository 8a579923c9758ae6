"""The registered query of each operator, over its whole table, and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (alignment, ann, bpe, chat, exact_dedup, jaccard, langid, license_scan, mixing, sharding, simhash,
                          spelling, token_counts)
from tidemark.llm.common import table
from tidemark.llm.license_sql import scan_sql

#: The vocabulary file of the token operators, and the limit of the counts.
VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: The files whose tokens are aligned.
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary(name: str = VOCABULARY) -> str:
    """Where the installed package of public tokenizers keeps a file."""
    import public_tokenizers
    return public_tokenizers.path(name)


REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return keep


def as_file(doc_id: str = "doc_id"):
    """The path of a document: its source, and folders of a thousand and of fifty ids."""
    def part(n):
        return F.floor(F.col(doc_id) / n).cast("string")
    return F.concat_ws("/", F.coalesce("source", F.lit("")), part(1000), part(50), F.col(doc_id).cast("string"))


@query("op1_license_scan", scan_sql("""SELECT doc_id, concat_ws('/', coalesce(source, ''), CAST(doc_id // 1000 AS VARCHAR),
    CAST(doc_id // 50 AS VARCHAR), CAST(doc_id AS VARCHAR)) AS path, text FROM documents"""))
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select("doc_id", as_file().alias("path"), "text")
    return license_scan.scan(files).drop("text")


@query("op2_chat")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.windows(rows.unionByName(more)))


@query("op3_exact_dedup", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


@query("op5_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.record_digest(sharding.shuffle_into_shards(table(spark, sf_dir, "documents"), n_shards=16))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary(), LIMIT)


@query("op9_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary(), decoded_col="decoded")
    return encoded.select("doc_id", *token_digests())


def token_digests() -> list:
    """Number of ids, and digests of the ids and of the decoded text, from what ``bpe.encode`` returns."""
    return [F.size("token_ids").cast("long").alias("n_tokens"),
            F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
            F.sha2(F.col("decoded"), 256).alias("decoded_sha256")]


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, most=2, seed=42)


# The blocks, sub-blocks and cuts of the operator come to one order of a source's documents, and a running sum over it.
@query("op6_mixing", """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    md5(concat_ws('|', '11', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))) AS m FROM documents),
  s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
    FROM d GROUP BY source),
  w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
    CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s),
  o AS (SELECT *, CAST(total - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, rank
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) / CAST(sum(weight) OVER (
      ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS share FROM w),
  l AS (SELECT min_by(share, (source_size / weight, rank)) AS level FROM o WHERE share * weight < 3 * source_size),
  t AS (SELECT source, source_size, total, coalesce(least(level * weight, CAST(3 * source_size AS DOUBLE)), 0.0) AS target,
    greatest(1, source_size * 16384 // greatest(total, 1)) AS blocks,
    CAST('0x' || substr(md5(concat_ws('|', '11', coalesce(source, ''))), 1, 6) AS BIGINT) AS shift FROM o, l),
  g AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
  p AS (SELECT d.doc_id, d.size, g.*, target - passes * source_size AS rest,
    CASE passes WHEN 0 THEN 2147483647 WHEN 1 THEN 2147483629 ELSE 2147483587 END
      * (CAST('0x' || substr(m, 1, 8) AS BIGINT) % blocks + shift) % blocks AS place,
    substr(m, 9, 3) AS sub, substr(m, 12, 12) AS u FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
  c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, sub, u, CAST(doc_id AS VARCHAR)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p)
SELECT doc_id, size, source_size, target,
  CAST(size * (passes + CASE WHEN rest > 0 AND before + size / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"))


@query("op10_langid")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~langid.is_held_out()))
    return langid.predict(docs.select("doc_id", "text"), model, keep=["doc_id"]).select(
        "doc_id", langid.is_held_out().alias("held_out"), "lang_pred", "score", "lang_spans")


@query("op4_ann")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


# CRC-32 byte by byte with its usual table; words one edit apart agree after one letter is masked or removed.
@query("op11_spelling", """
WITH RECURSIVE c AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc),
  r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
  k AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h
    FROM r WHERE length(run) >= 6 GROUP BY doc_id, run),
  s AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2),
    lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS INT), 2) AS BIGINT))),
    lambda a, b: xor(a >> 8, crc[CAST(xor(a & 255, b) AS INT) + 1]))) AS h FROM k, c),
  w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
    ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n FROM s GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
  p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
  v AS (SELECT word, n, substr(word, 1, CAST(i - 1 AS INT)) || '?' || substr(word, CAST(i + 1 AS INT)) AS masked,
    substr(word, 1, CAST(i - 1 AS INT)) || substr(word, CAST(i + 1 AS INT)) AS less FROM p),
  e AS (SELECT a.word, b.word AS other, b.n AS m FROM v a JOIN v b ON a.masked = b.masked AND a.word <> b.word
    UNION SELECT v.word, w.word, w.n FROM v JOIN w ON v.less = w.word
    UNION SELECT w.word, v.word, v.n FROM v JOIN w ON v.less = w.word),
  b AS (SELECT word, count(*) AS n_near, max(m) AS most, min_by(other, (-m, other)) AS best FROM e GROUP BY word),
  f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN best END AS form,
    CASE WHEN most >= 5 * n THEN most END AS form_n FROM w LEFT JOIN b USING (word)),
  t AS (SELECT word, word AS root, form FROM f UNION ALL SELECT t.word, f.word, f.form FROM t JOIN f ON t.form = f.word)
SELECT f.word, f.form, t.root, f.n, f.n_near, f.form_n FROM f JOIN t ON f.word = t.word AND t.form IS NULL""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"), least=6, slip=199)
    return spelling.variants(words.filter("n >= 5"), ratio=5)


@query("op12_jaccard", """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM w),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  i AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  l AS (SELECT u, v FROM i JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * common >= 80 * (a.n + b.n - common)),
  r AS (SELECT u, v FROM l UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(w.doc_id, min(r.v)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.u = w.doc_id GROUP BY w.doc_id""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), shingle=5, percent=80)


@query("op13_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), vocabulary(BYTE_LEVEL), vocabulary(PIECES))
