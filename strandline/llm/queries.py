"""The queries of this subpackage and, where SQL can express one, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair of which the document holds the item."""
    from strandline.llm.decontaminate import contaminated

    return contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    from strandline.llm.pii import find_spans

    found = find_spans(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    from strandline.llm.ann import NeighbourGraph

    found = NeighbourGraph.build(_read(spark, sf_dir, "embeddings")).search(queries="id % 100 = 0")
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the model of trusted text, and whether it is kept."""
    from strandline.llm.quality import decide, score

    scored = score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return decide(scored).select("doc_id", "perplexity", "threshold", "keep")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from strandline.llm.html import extract

    return extract(_read(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written and read back."""
    from strandline.llm.warc import read_records, write_archives

    back = read_records(spark, write_archives(_read(spark, sf_dir, "pages")))
    return back.selectExpr("id as page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to token files and read back."""
    from strandline.llm.tokenfile import read_token_files, write_token_files

    back = read_token_files(spark, write_token_files(_read(spark, sf_dir, "documents")))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into power-of-two sequences."""
    from strandline.llm.packing import pack

    packed = pack(_read(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    from strandline.llm.simhash import group_documents

    return group_documents(_read(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    from strandline.llm.langid import identify

    return identify(_read(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: f for k, f in globals().items() if k[:2] == "op" and k[2:3].isdigit()}
    return dict(sorted(found.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))


OP6_SQL = """
with p as (
    select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), f as (select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by 1)
select page_id, payload_bytes, payload_digest,
    case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 100 and page_id <> first then first end as refers_to
from p left join f using (payload_digest)
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_warc": OP6_SQL}
