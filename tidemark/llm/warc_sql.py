"""DuckDB SQL for the WARC derivatives of ``pages``."""

from __future__ import annotations

from .warc import BLOCKS, ENTITIES, HIDDEN, NUMERIC


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _uuid(h: str) -> str:
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in cut) + " || '>'"


def _unescape(x: str) -> str:
    n = (
        "CASE WHEN regexp_matches(m, '^&#[xX]') THEN CAST('0x' || regexp_replace(m, '[&#;xX]', '', 'g') AS BIGINT) "
        "ELSE CAST(regexp_replace(m, '[&#;]', '', 'g') AS BIGINT) END"
    )
    char = f"CASE WHEN {n} = 0 OR {n} > 1114111 OR {n} BETWEEN 55296 AND 57343 THEN '�' ELSE chr(CAST({n} AS INTEGER)) END"
    found = f"list_distinct(regexp_extract_all({x}, {_text(NUMERIC)}))"
    out = f"list_reduce(list_prepend({x}, {found}), lambda acc, m: replace(acc, m, {char}))"
    for name, ch in ENTITIES.items():
        out = f"replace({out}, {_text(name)}, {_text(ch)})"
    return f"replace({out}, '&amp;', '&')"


def _header(kind: str, content_type: str) -> str:
    return (
        f"concat_ws(chr(13) || chr(10), 'WARC/1.1', 'WARC-Type: {kind}', 'WARC-Record-ID: ' || did, "
        "'WARC-Refers-To: ' || rid, 'WARC-Target-URI: ' || url, 'WARC-Date: ' || date, "
        f"'WARC-Block-Digest: ' || block_digest, 'Content-Type: {content_type}', "
        "'Content-Length: ' || CAST(strlen(block) AS VARCHAR)) || chr(13) || chr(10) || chr(13) || chr(10)"
    )


def _plain(x: str) -> str:
    out = f"regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')"
    for tag in HIDDEN:
        out = f"regexp_replace({out}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', chr(10), 'g')"
    out = f"regexp_replace({out}, '\\s+', ' ', 'g')"
    out = f"regexp_replace({out}, '(?i)</?(?:{BLOCKS})\\b[^>]*>', chr(10), 'g')"
    return f"regexp_replace({out}, '<[A-Za-z/!?][^>]*>', '', 'g')"


_BLANK = r"[ \t\r\f\x{00A0}]+"
_META, _CONV = "application/warc-fields", "text/plain; charset=utf-8"

SQL = rf"""
WITH src AS (
  SELECT page_id, url, coalesce(html, '') AS payload, '2024-01-01T00:00:00Z' AS date,
         md5(concat_ws(chr(10), 'response', coalesce(CAST(page_id AS VARCHAR), ''), coalesce(url, ''), coalesce(html, ''))) AS h
  FROM pages),
a AS (
  SELECT page_id, url, date, payload, {_uuid('h')} AS rid, 'sha256:' || sha256(payload) AS source_digest,
         {_plain('payload')} AS bare, regexp_extract(payload, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1) AS raw_title,
         [CASE WHEN x[1] IN ('"', '''') THEN x[2:-2] ELSE x END FOR x IN
          regexp_extract_all(payload, '(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"\r\n]*"|''[^''\r\n]*''|[^\s"''>]+)', 1)] AS links
  FROM src),
b AS (
  SELECT *, {_unescape('bare')} AS shown, {_unescape('raw_title')} AS title FROM a),
c AS (
  SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(shown, '{_BLANK}', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'),
                 '^\n|\n$', '', 'g'), ' ') AS conv,
         concat_ws(chr(13) || chr(10), 'title: ' || trim(regexp_replace(title, '[ \t\r\n\f\x{{00A0}}]+', ' ', 'g'), ' '),
           'source-payload-digest: ' || source_digest, 'source-payload-length: ' || CAST(strlen(payload) AS VARCHAR),
           'source-header: HTTP/1.1 200 OK', 'source-header: Content-Type: text/html; charset=utf-8',
           'source-header: Content-Length: ' || CAST(strlen(payload) AS VARCHAR))
         || chr(13) || chr(10) || array_to_string([('outlink: ' || replace(l, '&amp;', '&') || chr(13) || chr(10)) FOR l IN links], '') AS meta
  FROM b),
d AS (
  SELECT page_id, rid, url, date, source_digest, 'metadata' AS kind, meta AS block FROM c
  UNION ALL SELECT page_id, rid, url, date, source_digest, 'conversion', conv FROM c),
e AS (
  SELECT *, 'sha256:' || sha256(block) AS block_digest, md5(kind || chr(10) || rid) AS h FROM d),
f AS (SELECT *, {_uuid('h')} AS did FROM e)
SELECT page_id, kind AS record_type, did AS record_id, rid AS refers_to, url AS target_uri, date,
       CASE WHEN kind = 'conversion' THEN '{_CONV}' ELSE '{_META}' END AS content_type,
       CAST(strlen(block) AS BIGINT) AS content_length, block_digest, source_digest,
       CASE WHEN kind = 'conversion' THEN {_header('conversion', _CONV)} ELSE {_header('metadata', _META)} END AS header,
       block
FROM f
"""
