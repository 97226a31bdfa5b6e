"""Links in letters: extraction, validity against a crawl table, scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.rules import URL_GOV, URL_INVALID, URL_LOOSE, URL_STRICT, URL_TAIL, URL_VALID

# Phrases by which a page says that it is not there, although it was served.
SOFT_404 = ("page you are looking for is not available", "article is currently not available")


def url_array(text: Column, mode: str = "loose") -> Column:
    """Every link in the text: ``score`` (lowercased text), ``loose``, or ``strict`` (checked host part)."""
    source = F.lower(text) if mode == "score" else text
    pattern = URL_STRICT if mode == "strict" else "(?U)" + URL_LOOSE
    return F.regexp_extract_all(source, F.lit(pattern), F.lit(0))


def extract_urls(df: DataFrame, key: Sequence[str], text: str = "text", mode: str = "loose") -> DataFrame:
    """One row per occurrence: the key columns, ``occurrence`` and ``url``.

    Texts without a scheme are dropped by a byte search before the pattern is tried.
    """
    linked = df.filter(F.contains(F.lower(F.col(text)) if mode == "score" else F.col(text), F.lit("http")))
    return linked.select(*key, F.posexplode(url_array(F.col(text), mode)).alias("occurrence", "url"))


def url_status(pages: DataFrame, url: str = "url", body: str = "html",
               soft404: Sequence[str] = SOFT_404) -> DataFrame:
    """(url, ok) from crawled pages; a page that says it is not available is not ok, unless it is a PDF.

    A page crawled more than once is ok if it was ok once.
    """
    gone = F.lit(False)
    for phrase in soft404:
        gone = gone | F.contains(F.lower(F.col(body)), F.lit(phrase.lower()))
    ok = F.contains(F.col(url), F.lit(".pdf")) | ~F.coalesce(gone, F.lit(False))
    return pages.groupBy(F.lower(F.col(url)).alias("url")).agg(F.max(ok.cast("int")).alias("ok"))


def url_candidates(url: Column) -> Column:
    """The link as written, then with its trailing punctuation taken off one character at a time."""
    stem = F.rtrim(url, F.lit(URL_TAIL))
    cut = F.length(url) - F.length(stem)
    return F.when(cut == 0, F.array(url)).otherwise(
        F.transform(F.sequence(F.lit(0), cut), lambda k: F.left(url, F.length(url) - k)))


def url_ok(urls: DataFrame, status: DataFrame) -> DataFrame:
    """(url, ok) for the distinct links of ``urls``: ok if the link, or a shortened form, is ok. Letter case is ignored.

    Links are made distinct before the join, with map-side partial aggregation, so the join sees each
    link once however often it occurs.
    """
    good = status.filter(F.col("ok").cast("boolean")).select(F.lower("url").alias("candidate")).distinct()
    forms = urls.select("url").distinct().select("url", F.explode(url_candidates(F.lower("url"))).alias("candidate"))
    return (forms.join(good.withColumn("_ok", F.lit(True)), "candidate", "left")
            .groupBy("url").agg(F.coalesce(F.bool_or("_ok"), F.lit(False)).alias("ok")))


def join_url_status(urls: DataFrame, status: DataFrame) -> DataFrame:
    """Occurrences with ``ok``. A hot link is split by AQE: the memo side has one row per link."""
    return urls.join(url_ok(urls, status), "url", "left")


def bad_urls(df: DataFrame, status: DataFrame, key: Sequence[str], text: str = "text") -> DataFrame:
    """Per row of ``df`` with an invalid link: ``bad_urls``, those links in order of occurrence."""
    occurrences = join_url_status(extract_urls(df, key, text), status).filter(~F.col("ok"))
    listed = F.sort_array(F.collect_list(F.struct("occurrence", "url")))
    return occurrences.groupBy(*key).agg(F.transform(listed, lambda u: u["url"]).alias("bad_urls"))


def url_score(df: DataFrame, status: DataFrame, key: Sequence[str], text: str = "text") -> DataFrame:
    """Per row of ``df`` with a link: ``url_score``, the sum over its occurrences.

    Repeats inside one row are counted before the join.
    """
    counted = (extract_urls(df, key, text, "score").groupBy(*key, "url").agg(F.count("*").alias("n")))
    gov = F.when(F.contains(F.col("url"), F.lit(".gov")), URL_GOV).otherwise(0)
    points = F.when(F.col("ok"), URL_VALID + F.length("url") + gov).otherwise(URL_INVALID)
    return (join_url_status(counted, status)
            .groupBy(*key).agg(F.sum((points * F.col("n")).cast("bigint")).alias("url_score")))
