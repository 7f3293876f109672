"""WARC derivatives: metadata and plain-text conversion records of response records.

``derive`` turns each response into two records. Both refer to the response by its id, carry
its target URI, date and headers, and the digest of the payload they come from; the metadata
record also names the conversion record. Record ids are digests of the response id, so a
rerun gives the same ids. ``write_warc`` writes records in the WARC 1.1 format.

Column expressions only; a record is made from one row, so nothing is shuffled.

Defined cases: a NULL or empty payload gives a conversion record of length 0 and a metadata
record without title; character references that HTML does not have stay as they are; NULL
headers and URIs are left out of the headers; repeated responses give repeated records; other
columns of the input are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The usual character references; &nbsp; becomes a plain space.
REFERENCES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"),
    ("&middot;", "·"), ("&amp;", "&"),
)
# All references of HTML: by number, by name, and by the old names that need no semicolon.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"
OLD_NAME = "^&(?:" + "|".join(sorted((x for x in html5 if x[-1] != ";"), key=lambda name: (-len(name), name))) + ")"
NAMED = json.dumps({f"&{name}": " " if character == "\xa0" else character for name, character in html5.items()})
# Numbers 128 to 159 mean the characters of windows-1252, where it has any.
LATIN = json.dumps({
    str(n): bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)})
# Elements that are dropped with their content, and those that end a line.
# What is not closed ends with the text, as in a browser; so no pattern looks at a text again and again.
DROPPED = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<title\b.*?(?:</title\s*>|\z)"
LINE_TAGS = r"(?i)</?(?:address|article|aside|blockquote|br|div|dd|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>"
OTHER_TAGS = r"<[^>]*>"
TITLE = r"(?is)<title\b[^<>]*>(.*?)(?:</title\s*>|\z)"
LANGUAGE = r"(?is)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)"
LINK = r"(?i)<a\b[^<>]*?\bhref\s*="


def record_id(*parts: Column) -> Column:
    """A urn:uuid made of a digest of the parts."""
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts]))


def _numbered(reference: Column) -> Column:
    """The character of a reference by number; U+FFFD where there is none."""
    digits = F.regexp_extract(reference, "^&#[xX]?0*([0-9a-fA-F]*)", 1)
    base = F.when(F.lower(F.substring(reference, 3, 1)) == "x", F.conv(digits, 16, 10)).otherwise(digits)
    number = F.when((digits != "") & (F.length(digits) < 9), base.cast("bigint")).otherwise(0)
    known = F.element_at(F.from_json(F.lit(LATIN), "map<string,string>"), number.cast("string"))
    wrong = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    coded = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(wrong, "\ufffd").when(number == 0xA0, " ").when(known.isNotNull(), known).otherwise(coded)


def _character(reference: Column) -> Column:
    usual = F.when(F.lit(False), F.lit(""))
    for name, character in REFERENCES:
        usual = usual.when(reference == name, character)
    named = F.from_json(F.lit(NAMED), "map<string,string>")
    old = F.regexp_extract(reference, OLD_NAME, 0)
    begun = F.concat(F.element_at(named, old), F.substr(reference, F.length(old) + 1))
    return usual.when(reference.startswith("&#"), _numbered(reference)).otherwise(
        F.coalesce(F.element_at(named, reference), begun, reference))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _decoded(text: Column) -> Column:
    """The text with its character references decoded, each once."""
    return _bound(text, _decoded_once)


def _decoded_once(text: Column) -> Column:
    characters = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)), _character)
    pieces = F.zip_with(
        F.split(text, REFERENCE, -1), characters, lambda piece, character: F.concat(piece, F.coalesce(character, F.lit(""))))
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def _without_tags(body: Column) -> Column:
    """Line ends for the tags of blocks, nothing for other tags; what follows the last ``>`` has none."""
    rest = F.substring_index(body, ">", -1)
    tagged = F.substr(body, F.lit(1), F.length(body) - F.length(rest))
    return F.concat(F.regexp_replace(F.regexp_replace(tagged, LINE_TAGS, "\n"), OTHER_TAGS, ""), rest)


def plain_text(html: Column) -> Column:
    """Visible text: one line per block element, single spaces, no empty lines.

    Takes time in proportion to the text, also where comments or tags are not closed.
    """
    body = F.regexp_replace(F.coalesce(html, F.lit("")), DROPPED, " ")
    body = _bound(F.regexp_replace(body, r"[\r\n]+", " "), _without_tags)
    body = F.regexp_replace(_decoded(body), r"[ \t]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(body, r" ?\n[ \n]*", "\n"), r"^\n+|\n+$", ""))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def responses_of_pages(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of a (page_id, url, html) table; the crawl date is a parameter."""
    return pages.select(
        record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                  F.coalesce("url", F.lit(""))).alias("record_id"),
        "page_id", F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8").alias("http_headers"),
        F.col("html").alias("payload"),
    )


def derive(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Two rows per response: a ``metadata`` and a ``conversion`` record.

    Needs record_id, target_uri, date, http_headers and payload; ``keep`` names further
    columns to carry along.
    """
    c = F.col
    made = responses.select(
        *keep, c("record_id").alias("refers_to"), "target_uri", "date",
        F.coalesce("http_headers", F.lit("")).alias("source_headers"),
        F.coalesce("payload", F.lit("")).alias("payload"),
        record_id(F.lit("conversion"), c("record_id")).alias("conversion_id"),
        record_id(F.lit("metadata"), c("record_id")).alias("metadata_id"),
    ).withColumns({"text": plain_text(c("payload")), "source_digest": digest(c("payload"))})
    title = F.trim(F.regexp_replace(_decoded(F.regexp_extract("payload", TITLE, 1)), r"\s+", " "))
    fields = F.concat(
        F.lit("title: "), title, F.lit("\r\nlanguage: "), F.regexp_extract("payload", LANGUAGE, 1),
        F.lit("\r\noutlinks: "), F.regexp_count("payload", F.lit(LINK)).cast("string"),
        F.lit("\r\nconversion: <"), c("conversion_id"), F.lit(">\r\nsource-digest: "), c("source_digest"),
        F.when(c("source_headers") == "", "").otherwise(F.concat(
            F.lit("\r\nsource-header: "),
            F.replace(c("source_headers"), F.lit("\r\n"), F.lit("\r\nsource-header: ")))),
        F.lit("\r\n"),
    )
    record = F.explode(F.array(
        F.struct(F.lit("metadata").alias("record_type"), c("metadata_id").alias("record_id"),
                 F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), c("conversion_id").alias("record_id"),
                 F.lit("text/plain; charset=utf-8").alias("content_type"), c("text").alias("block")),
    ))
    return made.select(*keep, "refers_to", "target_uri", "date", "source_headers", "source_digest",
                       record.alias("r")).select(
        *keep, "r.record_type", "r.record_id", "refers_to", "target_uri", "date", "r.content_type",
        F.octet_length("r.block").cast("bigint").alias("content_length"),
        digest(c("r.block")).alias("block_digest"), "source_digest", "source_headers", "r.block",
    )


def warc_text(records: DataFrame) -> DataFrame:
    """One string column: the records in the WARC 1.1 format, without the last line end."""
    def header(name: str, value: Column) -> Column:
        one_line = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
        return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), one_line, F.lit("\r\n")))

    def linked(name: str) -> Column:
        return F.concat(F.lit("<"), F.col(name), F.lit(">"))

    return records.select(F.concat(
        F.lit("WARC/1.1\r\n"), header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", linked("record_id")), header("WARC-Refers-To", linked("refers_to")),
        header("WARC-Target-URI", F.col("target_uri")), header("WARC-Date", F.col("date")),
        header("WARC-Block-Digest", F.col("block_digest")), header("Content-Type", F.col("content_type")),
        F.lit("Content-Length: "), F.col("content_length").cast("string"), F.lit("\r\n\r\n"),
        F.col("block"), F.lit("\r\n"),
    ).alias("value"))


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Write WARC files, one per partition, by Spark's text writer; rerun tasks overwrite their file."""
    warc_text(records).write.option("lineSep", "\r\n").option("compression", compression).text(path)
