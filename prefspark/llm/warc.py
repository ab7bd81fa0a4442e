"""Derivative records of web captures: metadata and plain text, linked to their responses.

Every response gives a metadata record (title and outlinks as ``application/warc-fields``)
and, if its content is text, a conversion record. Both name the response in ``refers_to``,
share its target and headers, and carry digests of the source payload and of their own block.
Built-in functions only, one scan, nothing shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps from HTML to plain text, in order: what is replaced, and by what.
TO_TEXT = (
    (r"(?s)<!--.*?-->", " "),
    (r"(?is)<script\b[^>]*>.*?</script\s*>", " "),
    (r"(?is)<style\b[^>]*>.*?</style\s*>", " "),
    (r"(?is)<head\b[^>]*>.*?</head\s*>", " "),
    (r"(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|footer|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>", "\n"),
    (r"<[^<>]*>", ""),
    (r"&nbsp;", " "),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", '"'),
    (r"&#39;", "'"),
    (r"&amp;", "&"),
    (r"[ \t\r\x0b\x0c]+", " "),
    (r" ?\n[ \n]*", "\n"),
    (r"^[ \n]+|[ \n]+$", ""),
)
TITLE = r"(?is)<title[^>]*>(.*?)</title"
#: Double-quoted links only, as the SQL check finds them.
LINK = r"(?i)<a\s[^>]*?href=\"([^\"]*)\""
#: The same with the quotes around the value, double, single or none.
ANY_LINK = r"""(?i)<a\s(?:[^>]*?[\s"'/])?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""


def digest(block: Column) -> Column:
    """Labelled SHA-256 of the block's bytes."""
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def record_id(*parts: Column) -> Column:
    """The same name for the same parts, in the form of a UUID."""
    code = F.md5(F.concat_ws("|", *(F.coalesce(p, F.lit("")) for p in parts)).cast("binary"))
    pieces = [F.substring(code, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def html_text(html: Column) -> Column:
    return reduce(lambda text, step: F.regexp_replace(text, step[0], F.lit(step[1])), TO_TEXT, html)


def responses_of(pages: DataFrame) -> DataFrame:
    """Response records of a table of pages (``page_id, url, html``).

    A null url is an empty target and a null html an empty payload.
    """
    payload = F.coalesce(pages["html"], F.lit(""))
    size = F.octet_length(payload).cast("string")
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n"))
    page, url = pages["page_id"].cast("string"), F.coalesce(pages["url"], F.lit(""))
    return pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        record_id(F.lit("response"), page, url).alias("record_id"),
        url.alias("target_uri"),
        headers.alias("headers"),
        payload.alias("payload"),
    )


def derivatives(responses: DataFrame) -> DataFrame:
    """Metadata and conversion records of responses (``page_id, record_id, target_uri, headers, payload``).

    HTML is reduced to its text, other ``text/`` content is kept as it is, and anything else
    has a metadata record only. Null headers count as HTML, a null payload as empty. An empty
    payload gives records with empty blocks. Repeated responses give repeated records with
    equal identifiers. Other columns are not read; an empty table gives no records.
    """
    payload = F.coalesce(responses["payload"], F.lit(""))
    headers = F.coalesce(responses["headers"], F.lit(""))
    kind = F.lower(F.regexp_extract(headers, r"(?im)^content-type:\s*([^;\s]+)", 1))
    html = kind.isin("", "text/html", "application/xhtml+xml")
    title = F.trim(F.regexp_replace(F.regexp_extract(payload, TITLE, 1), r"\s+", " "))
    found = F.regexp_extract_all(payload, F.lit(ANY_LINK), F.lit(1))
    links = F.transform(found, lambda x: F.concat(F.lit("outlink: "), F.regexp_replace(x, r"""(?s)^(["'])(.*)\1$""", F.lit("$2"))))
    fields = F.array_join(F.concat(F.array(F.concat(F.lit("title: "), title)), links), "\r\n")

    def derived(record_type: str, content_type: str, block: Column) -> Column:
        return F.struct(F.lit(record_type).alias("record_type"), F.lit(content_type).alias("content_type"), block.alias("block"))

    records = F.array(
        derived("metadata", "application/warc-fields", F.when(html, fields).otherwise("")),
        derived("conversion", "text/plain", F.when(html, html_text(payload)).otherwise(payload)),
    )
    has_text = html | kind.startswith("text/")
    rows = responses.select(
        responses["page_id"],
        responses["record_id"].alias("refers_to"),
        responses["target_uri"],
        headers.alias("source_headers"),
        digest(payload).alias("payload_digest"),
        F.inline(F.filter(records, lambda r: has_text | (r["record_type"] == "metadata"))),
    )
    return rows.select(
        "page_id",
        "record_type",
        record_id(F.col("record_type"), F.col("refers_to")).alias("record_id"),
        "refers_to",
        "target_uri",
        "source_headers",
        "payload_digest",
        "content_type",
        F.octet_length("block").cast("long").alias("content_length"),
        digest(F.col("block")).alias("block_digest"),
        "block",
    )


def warc_text(records: DataFrame) -> DataFrame:
    """One column ``record``: each record in the form of a WARC file, ready for ``write.text``."""
    lines = [F.lit("WARC/1.1")] + [
        F.concat(F.lit(f"{name}: "), records[column].cast("string"))
        for name, column in (
            ("WARC-Type", "record_type"),
            ("WARC-Record-ID", "record_id"),
            ("WARC-Refers-To", "refers_to"),
            ("WARC-Target-URI", "target_uri"),
            ("WARC-Payload-Digest", "payload_digest"),
            ("WARC-Block-Digest", "block_digest"),
            ("Content-Type", "content_type"),
            ("Content-Length", "content_length"),
        )
    ]
    return records.select(F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), records["block"], F.lit("\r\n\r\n")).alias("record"))
