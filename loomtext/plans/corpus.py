"""Adapters from the driver tables to the record shapes the operators take.

* ``pages`` -> browse records ``(page_id, url, title, kw, line)`` with the raw
  backtick line ``url=...`tit=...`kw=...``; title from ``<title>``, keywords from the
  navigation link texts.
* ``pages`` -> a rule table: fixed seed rules plus one rule per host (so the
  table grows with the data).
* ``documents`` -> token documents ``(doc_id, lang, tokens)``; with the category
  dictionary, ``label`` is the language's id.
* ``events`` -> identity records with ``uid / imei / snid / sn`` fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.functions.hashing import hash_number
from loomtext.functions.text import doc_tokens
from loomtext.operators.vocab import category_dictionary, with_category_id
from loomtext.sources.tables import spread, table

TITLE_RE = r"<title>(.*?)</title>"
NAV_LINK_RE = r'<a href="[^"]*">([^<]*)</a>'
HOST_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)"
HOST_SALT = "host:"

# Seed URL rules (ord, pattern, tag). Ties, a spaced tag and path and
# query hits are included on purpose.
SEED_RULES = [
    (1, ".example.com", "0001"),
    (2, ".example.net", "0002"),
    (3, ".example.org", "0003"),
    (4, "blog.", "0004"),
    (5, "casino", "0005"),
    (6, "ads-track.", "0006"),
    (7, "/fr/", "0007"),
    (8, "/de/", "0008"),
    (9, ".html", "0010"),
    (10, "?page=", "0011"),
    (11, "www.", "0012"),
    (12, "m.ththth.example.net", "0009"),
    (13, "ththnd.example", "0013"),
    (14, "ththnd.example", "0014"),
    (15, "tionble.example", "0015 "),
    (16, "tionble.example", "0016"),
]
HOST_RULE_ORD_BASE = 1000


def page_records(pages: DataFrame) -> DataFrame:
    pages = spread(pages.select("page_id", "url", "html"), "page_id")
    title = F.regexp_extract(F.col("html"), TITLE_RE, 1)
    kw = F.array_join(F.regexp_extract_all(F.col("html"), F.lit(NAV_LINK_RE), F.lit(1)), " ")
    rec = pages.select("page_id", "url", title.alias("title"), kw.alias("kw"))
    line = F.concat(F.lit("url="), F.col("url"), F.lit("`tit="), F.col("title"), F.lit("`kw="), F.col("kw"))
    return rec.withColumn("line", line)


def page_rules(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Seed rules plus ``host -> 4-digit tag`` for every host;
    ``ord`` of a host rule = 1000 + the smallest page id carrying that host."""
    seeds = spark.createDataFrame(SEED_RULES, "ord long, pattern string, tag string")
    host = F.regexp_extract(F.col("url"), HOST_RE, 1)
    hosts = pages.select(host.alias("pattern"), "page_id").where(F.col("pattern") != "")
    hosts = hosts.groupBy("pattern").agg((F.min("page_id") + HOST_RULE_ORD_BASE).alias("ord"))
    b = hash_number(F.col("pattern"), HOST_SALT)
    derived = hosts.select(
        "ord", "pattern", F.lpad((b % 32 + 1).cast("string"), 4, "0").alias("tag"))
    return seeds.unionByName(derived)


def token_docs(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, lang, tokens)`` for every document."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "lang", "text"), "doc_id")
    return docs.select("doc_id", "lang", doc_tokens(F.col("text")).alias("tokens"))


def labelled_docs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Token documents with ``label`` = category id of the language, and the
    dictionary ``(name, category_id)``."""
    td = token_docs(spark, sf)
    dictionary = category_dictionary(td, "lang")
    docs = with_category_id(td, dictionary, "lang").withColumnRenamed("category_id", "label")
    return docs, dictionary


def event_records(events: DataFrame) -> DataFrame:
    """``(event_id, line)`` with identity fields derived from the user id: some blank,
    some ``null``, some only a serial number."""
    u = F.col("user_id")
    uid = F.when(u % 4 == 0, F.lit("null")).when(u % 4 == 1, F.lit(" ")).otherwise(F.concat(F.lit("u"), u))
    imei = F.when(u % 3 == 0, F.concat(F.lit("im"), u)).otherwise(F.lit(""))
    snid = F.when(u % 5 == 0, F.concat(F.lit(" s"), u, F.lit(" "))).otherwise(F.lit("NULL"))
    sn = F.when(u % 2 == 0, F.concat(F.lit("a-"), u, F.lit("-z"))).otherwise(F.concat(F.lit("b-"), u))
    line = F.concat(F.lit("uid="), uid, F.lit("`imei="), imei, F.lit("`snid="), snid, F.lit("`sn="), sn,
                    F.lit("`type="), F.col("event_type"))
    return events.select("event_id", line.alias("line"))
