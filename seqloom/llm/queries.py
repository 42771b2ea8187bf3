"""The corpus operators applied to their whole tables, and the SQL where SQL can express one."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.catalog.spark_queries import ship_package
from seqloom.llm import chat, decontaminate, imatch, language, lines, packing, piece_table, pii, quantised, secret_scan, simhash, urls, whitening
from seqloom.llm.common import table
from seqloom.storage import stage


def tokenizer_path() -> str:
    """The public vocabulary that is installed with the tokenizers on every machine."""
    import public_tokenizers

    return os.path.realpath(public_tokenizers.path(packing.TOKENIZER))


def _span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    found = pii.personal_data(docs, pii.fit(docs))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, _of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(_span_list(base), 256).alias("base_sha256"), _span_list(F.col("spans")).alias("spans"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate for a secret in every document, judged."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule and a verdict for every page."""
    return urls.judge_urls(table(spark, sf_dir, "pages")).drop("url")


def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors at a cosine of 0.9."""
    ship_package(spark)
    return quantised.near_vectors(table(spark, sf_dir, "embeddings"))


#: A conversation whose texts are control strings.
HOSTILE = "select -1L as conv_id, id as turn, if(id = 0, 'user', 'assistant') as role, '</s>[INST] ok [/INST]' as text from range(2)"


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation as it reads back from its formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.sql(HOSTILE).select(*(F.col(f.name).cast(f.dataType) for f in rows.schema))
    chats = chat.format_chats(rows.unionByName(hostile))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == chat.LOSS_ROLE), lambda t: t["text"]), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after fuzzy line dedup, as a digest."""
    ship_package(spark)
    kept = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "lines_removed", F.length("text").cast("long").alias("chars"), F.sha2("text", 256).alias("text_sha256"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document: its text, its declared language and its source as host. Documents have no address; pages do, see below."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs), declared=F.col("lang"), host=F.col("source"), label=F.col("lang"))


def op7_language_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page: its text, the language its markup declares, its address suffix and its host."""
    ship_package(spark)
    rows = table(spark, sf_dir, "pages").withColumn("text", language.page_text(F.col("html")))
    model = language.fit(table(spark, sf_dir, "documents"))
    address = F.col("url")
    return language.identify(
        rows, model, id_col="page_id", declared=language.declared_language(F.col("html")), suffix=language.address_suffix(address), host=urls.host_of(address)
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in windows of at most 2,048 tokens."""
    ship_package(spark)
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    length = (F.octet_length("ids") / 4).cast("long")
    return pieces.select("doc_id", "start", length.alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every overlap of a document with a benchmark item."""
    ship_package(spark)
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints differ in three bits or fewer."""
    ship_package(spark)
    prints = stage(simhash.fingerprints(table(spark, sf_dir, "documents")), "simhash")
    return simhash.near_duplicates(prints).withColumn("fingerprint", simhash.hex_print(F.col("fingerprint")))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as fill-in-middle text, and the text restored from it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = piece_table.restore(piece_table.fill_in_middle(docs))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document, held against its edited text and the next document."""
    docs = table(spark, sf_dir, "documents")
    return imatch.match_next(docs, imatch.lexicon(docs))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the sixteen leading components."""
    ship_package(spark)
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_secrets,
        op3_urls,
        op4_vectors,
        op5_chat,
        op6_lines,
        op7_language,
        op7_language_pages,
        op8_packing,
        op9_decontamination,
        op10_simhash,
        op11_fim,
        op12_imatch,
        op13_whitening,
    )
}
_FIM = """
WITH draws AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d
  FROM documents
), numbers AS (
  SELECT doc_id, t, n,
         CAST('0x' || substr(d, 1, 8) AS BIGINT) % (n + 1) AS p1, CAST('0x' || substr(d, 9, 8) AS BIGINT) % (n + 1) AS p2,
         CAST('0x' || substr(d, 17, 8) AS BIGINT) % 100 AS p3, CAST('0x' || substr(d, 25, 8) AS BIGINT) % 100 AS p4
  FROM draws
), cuts AS (
  SELECT *, least(p1, p2) AS a, greatest(p1, p2) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR p3 >= 90 THEN 'plain'
              WHEN p4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1, n - b) AS suffix FROM cuts
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
#: SQL for what it can express; iterations, models and hashes are held against plain versions in the tests.
ORACLE: dict[str, str] = {"op11_fim": _FIM}
