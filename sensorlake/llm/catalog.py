"""The queries of the text operators, over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.common import doc_crc, table
from sensorlake.llm.decontamination import leaks
from sensorlake.llm.htmltext import extract_main_text
from sensorlake.llm.infill import fill_in_middle, restored
from sensorlake.llm.language import identify
from sensorlake.llm.linededup import drop_repeated_lines
from sensorlake.llm.multiindex import nearest
from sensorlake.llm.packing import pack
from sensorlake.llm.pseudolm import word_likelihood
from sensorlake.llm.sharding import histogram_shards
from sensorlake.llm.simhash import near_duplicates
from sensorlake.llm.spelling import spelling_variants
from sensorlake.llm.tokencount import token_counts, zipf_vocabulary
from sensorlake.llm.toxicity import toxicity_scores

PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    held_out = doc_crc() % 4 == 2
    found = identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth, by inner product."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, three-word shingles, two bits."""
    found = near_duplicates(table(spark, sf_dir, "documents"), width=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")


@query
def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of equal bytes."""
    sharded = histogram_shards(table(spark, sf_dir, "documents"), 8)
    return sharded.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 20 code points or more that three documents share."""
    kept = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(
        F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLES["op5_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id < r.owner AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key AND length(k.key) >= 20)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item or an edited copy of one."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens, alike ones next to each other."""
    import public_tokenizers

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones that are not held out."""
    scored = toxicity_scores(table(spark, sf_dir, "documents").select("doc_id", "text"),
                             table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (doc_crc() % 5 == 0).alias("held_out"), "score", "predicted")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document under a public vocabulary."""
    import public_tokenizers

    vocabulary = zipf_vocabulary(public_tokenizers.path(PIECES))
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).drop("text")


@query
def op10_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document under a network trained on all of them."""
    return word_likelihood(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    found = extract_main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars")


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with their commoner forms; every 31st run is misspelled first."""
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"), least=7, seen=2, every=31, ratio=10)


# The CRC-32 goes through the bytes' halves with the sixteen fixed values of its table.
ORACLES["op12_spelling_variants"] = """
WITH RECURSIVE raw AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS name,
    unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run FROM documents),
runs AS (
  SELECT name, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM raw WHERE length(run) >= 7 GROUP BY ALL),
halves AS (SELECT *, hex(name || ':' || run) AS hx FROM runs),
hashed AS (
  SELECT *, xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(length(hx)),
      lambda i: CAST(strpos('0123456789ABCDEF', hx[i + 2 - 2 * (i % 2)]) - 1 AS BIGINT)),
    lambda crc, half: xor([0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
      3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108
      ][(xor(crc, half) & 15) + 1], crc >> 4))) AS h FROM halves),
altered AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, k FROM hashed),
words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM altered WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
less AS (
  SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
shorter AS (SELECT DISTINCT l.word, l.n, w.word AS other, w.n AS other_n FROM less l JOIN words w ON l.rest = w.word),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT word, other, other_n FROM shorter
  UNION ALL SELECT other, word, n FROM shorter),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n
  FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= 10 * w.n THEN b.form END AS form,
    CASE WHEN b.form_n >= 10 * w.n THEN b.form_n END AS form_n FROM words w LEFT JOIN best b USING (word)),
ways AS (
  SELECT word, coalesce(form, word) AS at, form IS NULL AS done FROM formed
  UNION ALL SELECT w.word, coalesce(f.form, f.word), f.form IS NULL FROM ways w JOIN formed f ON f.word = w.at WHERE NOT w.done)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN ways w ON w.word = f.word AND w.done
"""


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its middle moved to the end, and the text rebuilt from that."""
    moved = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), seed=1)
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return moved.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                        digest(F.col("output")).alias("output_sha256"), digest(restored()).alias("restored_sha256"))


ORACLES["op13_fill_in_middle"] = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS c1,
    CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS c2, CAST('0x' || h[17:24] AS BIGINT) % 100 AS d3,
    CAST('0x' || h[25:32] AS BIGINT) % 100 AS d4 FROM units),
cut AS (
  SELECT *, array_to_string(u[1:least(c1, c2)], '') AS head, array_to_string(u[greatest(c1, c2) + 1:], '') AS tail,
    array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d3 >= 90
      THEN 'plain' WHEN d4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(head) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || tail || '<P>' || head || '<M>' || middle
    ELSE '<P>' || head || '<S>' || tail || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM cut
"""
