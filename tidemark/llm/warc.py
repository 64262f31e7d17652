"""WARC derivatives: metadata and plain-text conversion records linked to their responses."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

CRLF = "\r\n"
HIDDEN = ("head", "script", "style", "noscript", "template", "svg", "iframe")
BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|html|"
    "li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul"
)
# Named character references of HTML and what they stand for; &amp; comes last.
ENTITIES = {
    "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&copy;": "©", "&reg;": "®",
    "&trade;": "™", "&middot;": "·", "&bull;": "•", "&hellip;": "…", "&ndash;": "–", "&mdash;": "—",
    "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”", "&laquo;": "«", "&raquo;": "»",
    "&euro;": "€", "&pound;": "£", "&sect;": "§", "&deg;": "°", "&times;": "×",
}
LONGEST = max(map(len, html5))
NUMERIC = "&#(?:[xX][0-9A-Fa-f]{1,6}|[0-9]{1,7});"


def record_id(*parts: Column) -> Column:
    """A urn:uuid made of a hash of the parts: the same record gets the same id in every run."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cut]), F.lit(">"))


def _digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def _char(m: Column) -> Column:
    digits = F.regexp_replace(m, "[&#;xX]", "")
    n = F.when(m.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("long")
    bad = (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
    return F.when(bad, F.lit("�")).otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))


def unescape(text: Column) -> Column:
    """Character references decoded once, from left to right: numeric ones and every name of HTML that ends in a semicolon.

    The text is cut at its ampersands; only what stands between one and the next semicolon is looked up, the names of
    ``ENTITIES`` first.
    """
    known = {name[1:]: char for name, char in {**ENTITIES, "&amp;": "&"}.items()}
    common = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    rest = {name: char for name, char in html5.items() if name.endswith(";") and name not in known}
    rare = F.from_json(F.lit(json.dumps(rest)), "map<string,string>")  # folded to a literal by the optimizer

    def decoded(part: Column, i: Column) -> Column:
        n = F.instr(part, ";")
        name = F.substring(part, F.lit(1), n)
        number = F.concat(F.lit("&"), name)
        # no name is longer, and none holds a blank; most texts between an ampersand and a semicolon fail here
        char = F.when(n.between(3, LONGEST) & (F.instr(name, " ") == 0), F.coalesce(
            F.element_at(common, name),
            F.when(name.startswith("#"), F.when(number.rlike(f"^{NUMERIC}$"), _char(number))).otherwise(F.element_at(rare, name)),
        ))
        shown = F.coalesce(F.concat(char, F.substring(part, n + 1, F.length(part))), F.concat(F.lit("&"), part))
        return F.when(i == 0, part).otherwise(shown)

    return F.array_join(F.transform(F.split(text, "&"), decoded), "")


def plain_text(html: Column) -> Column:
    """Visible text: hidden elements, comments and tags out, one line per block, blanks collapsed."""
    out = F.regexp_replace(html, "(?s)<!--.*?-->", "")
    out = F.regexp_replace(out, rf"(?is)<({'|'.join(HIDDEN)})\b[^>]*>.*?</\1\s*>", "\n")
    out = F.regexp_replace(out, r"[\n\r]+", " ")  # other blanks are collapsed at the end
    out = F.regexp_replace(out, rf"(?i)</?(?:{BLOCKS})\b[^>]*>", "\n")
    out = F.regexp_replace(out, r"<[A-Za-z/!?][^>]*>", "")
    return _tidy(unescape(out))


def _tidy(text: Column) -> Column:
    out = F.regexp_replace(text, "[ \\t\\r\\f\\u00A0]{2,}|[\\t\\r\\f\\u00A0]", " ")
    return F.btrim(F.regexp_replace(out, " ?\\n[ \\n]*", "\n"), F.lit(" \n"))


def title(html: Column) -> Column:
    raw = F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)
    return F.trim(F.regexp_replace(unescape(raw), "[ \\t\\r\\n\\f\\u00A0]+", " "))


def outlinks(html: Column) -> Column:
    """Targets of anchors in order: quoted values up to the same quote, or unquoted ones, references decoded."""
    found = F.regexp_extract_all(html, F.lit(r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"\r\n]*"|'[^'\r\n]*'|[^\s"'>]+)"""), F.lit(1))

    def value(x: Column) -> Column:
        quoted = F.substring(x, 1, 1).isin('"', "'")
        return unescape(F.when(quoted, F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(x))

    return F.transform(found, value)


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of ``pages`` (page_id, url, html): record_id, target_uri, date, http_headers, payload.

    Pages carry neither date nor headers: ``date`` is given, the header block is the least a server sends.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(payload).cast("string"),
    )
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        record_id(F.lit("response"), F.col("page_id"), F.col("url"), F.col("html")).alias("record_id"),
        F.col("url").cast("string").alias("target_uri"),
        F.lit(date).alias("date"),
        head.alias("http_headers"),
        payload.alias("payload"),
    )


def _header(kind: str, content_type: str) -> Column:
    uri = F.when(F.col("target_uri").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), F.col("target_uri")))
    return F.concat(
        F.concat_ws(
            CRLF,
            F.lit("WARC/1.1"),
            F.lit(f"WARC-Type: {kind}"),
            F.concat(F.lit("WARC-Record-ID: "), F.col("derived_id")),
            F.concat(F.lit("WARC-Refers-To: "), F.col("record_id")),
            uri,
            F.concat(F.lit("WARC-Date: "), F.col("date")),
            F.concat(F.lit("WARC-Block-Digest: "), F.col("block_digest")),
            F.lit(f"Content-Type: {content_type}"),
            F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")),
        ),
        F.lit(CRLF + CRLF),
    )


def derivatives(records: DataFrame, *keep: str) -> DataFrame:
    """Two records per response: one of type metadata, one of type conversion (text/plain).

    ``records`` has record_id, target_uri, date, http_headers and payload (as of ``responses``); ``keep`` are further
    columns to return. Returns record_type, record_id, refers_to (the response), target_uri, date, content_type,
    content_length (bytes), block_digest, source_digest (of the response's payload), header (the WARC header) and block.
    The metadata block is application/warc-fields: title, source digest and length, the source's HTTP
    headers line by line, and outlinks in order.

    Nothing is shuffled. A null or empty payload gives an empty text; a null target_uri is left out of
    the header; repeated responses give repeated records with equal ids.
    """
    payload = F.coalesce(F.col("payload").cast("string"), F.lit(""))
    source = records.select(*keep, "record_id", "target_uri", "date", "http_headers", payload.alias("payload")).withColumn(
        "source_digest", _digest(F.col("payload"))
    )
    headers = F.transform(
        F.filter(F.split(F.coalesce("http_headers", F.lit("")), "\\r?\\n"), lambda x: x != ""),
        lambda x: F.concat(F.lit("source-header: "), x),
    )
    links = F.transform(outlinks(F.col("payload")), lambda x: F.concat(F.lit("outlink: "), x))
    fields = F.concat(
        F.array(
            F.concat(F.lit("title: "), title(F.col("payload"))),
            F.concat(F.lit("source-payload-digest: "), F.col("source_digest")),
            F.concat(F.lit("source-payload-length: "), F.octet_length("payload").cast("string")),
        ),
        headers,
        links,
    )
    both = source.select(
        *keep, "record_id", "target_uri", "date", "source_digest",
        F.explode(
            F.array(
                F.struct(F.lit("metadata").alias("kind"), F.concat(F.array_join(fields, CRLF), F.lit(CRLF)).alias("block")),
                F.struct(F.lit("conversion").alias("kind"), plain_text(F.col("payload")).alias("block")),
            )
        ).alias("d"),
    ).select(
        *keep, "record_id", "target_uri", "date", "source_digest", F.col("d.kind").alias("record_type"), F.col("d.block").alias("block")
    )
    both = both.withColumn("derived_id", record_id(F.col("record_type"), F.col("record_id"))).withColumn(
        "block_digest", _digest(F.col("block"))
    )
    conversion = F.col("record_type") == "conversion"
    types = ("application/warc-fields", "text/plain; charset=utf-8")
    return both.select(
        *keep,
        "record_type",
        F.col("derived_id").alias("record_id"),
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "date",
        F.when(conversion, types[1]).otherwise(types[0]).alias("content_type"),
        F.octet_length("block").cast("long").alias("content_length"),
        "block_digest",
        "source_digest",
        F.when(conversion, _header("conversion", types[1])).otherwise(_header("metadata", types[0])).alias("header"),
        "block",
    )


def serialised(records: DataFrame) -> DataFrame:
    """record: the bytes of each derived record as they stand in a WARC file."""
    return records.select(
        F.concat(F.col("header").cast("binary"), F.col("block").cast("binary"), F.lit(b"\r\n\r\n")).alias("record")
    )
