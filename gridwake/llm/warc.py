"""WARC derivatives: linked metadata and plain-text conversion records.

Each captured response yields two records. The *metadata* record describes
the capture (title, language, outgoing links, sizes) as
``application/warc-fields``; the *conversion* record holds its visible text.
Both name the response in ``WARC-Refers-To``, repeat the source headers that
belong to the capture (target URI, date, and any further ``WARC-`` headers
given), carry the response's payload digest, and have a block digest of their
own; the conversion record also names the metadata record as concurrent.

Record ids are derived from the content (SHA-1 of URI, date and payload, per
record type), so a rerun writes the same records. Digests are ``sha1:`` in
base 32. Where the source has no record id it gets the derived one.

Defined results: a null payload is empty (its text and links too); a null URI
leaves the target URI header out; a null date takes the ``date`` default.
Header values lose line breaks. Very long pages are handled whole, in time
that grows with their length whatever they hold: every search moves forward
only. Repeated rows give equal records, an empty table none; there are no
ties. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
SCHEMA = ("record_type string, record_id string, refers_to string, concurrent_to string, target_uri string, "
          "date string, content_type string, payload_digest string, block_digest string, content_length long, "
          "headers string, block string")
_COLUMNS = [part.split()[0] for part in SCHEMA.split(", ")]

# beginnings of tags; where a tag ends is looked up from there, each place of the page once
_UNSEEN = re.compile(r"(?i)<(script|style|noscript|template|head)\b|<!--")
_BREAK = re.compile(r"(?i)</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|nav|article|section|header|footer|aside|main|"
                    r"blockquote|pre|form|hr|dl|dt|dd|figure|title|body|html)\b")
_TAG = re.compile(r"<[a-zA-Z/!?]")
_BLANK = re.compile(r"[ \t\f\v\xa0]+")
_LINES = re.compile(r" ?\n[ \n]*")
_TITLE = re.compile(r"(?i)<title\b")
_HTML = re.compile(r"(?i)<html\b")
_LANG = re.compile(r"(?i)\blang\s*=\s*[\"']?([\w-]+)")
_LINK = re.compile(r"(?i)<a\b")
_HREF = re.compile(r"(?i)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")


class _Next:
    """The first match of ``pattern`` at or after a position. Positions must
    not fall, so a page is searched once however often this is asked."""

    def __init__(self, pattern: re.Pattern, text: str):
        self.pattern, self.text, self.match, self.gone = pattern, text, None, False

    def after(self, at: int) -> re.Match | None:
        if not self.gone and (self.match is None or self.match.start() < at):
            self.match = self.pattern.search(self.text, at)
            self.gone = self.match is None
        return None if self.gone else self.match


def _without_unseen(page: str) -> str:
    """The page with a blank for each comment and each closed element that is
    not shown; where the end is missing, the beginning counts as a plain tag."""
    out, at = [], 0
    gt, ends = _Next(re.compile(">"), page), {}
    for m in _UNSEEN.finditer(page):
        if m.start() < at:
            continue
        name = (m[1] or "").lower()
        begin = gt.after(m.end()) if name else m
        if begin is None:
            continue
        if name not in ends:
            ends[name] = _Next(re.compile(rf"(?i)</{name}\s*>" if name else "-->"), page)
        end = ends[name].after(begin.end())
        if end is not None:
            out += [page[at:m.start()], " "]
            at = end.end()
    out.append(page[at:])
    return "".join(out)


def _replace_tags(text: str, opening: re.Pattern, by: str) -> str:
    out, at = [], 0
    for m in opening.finditer(text):
        if m.start() < at:
            continue
        end = text.find(">", m.end())
        if end < 0:
            break
        out += [text[at:m.start()], by]
        at = end + 1
    out.append(text[at:])
    return "".join(out)


def visible_text(page: str) -> str:
    """Text of an HTML page: no scripts, styles, head or comments; block tags
    break lines; entities are decoded; blanks are collapsed."""
    text = _replace_tags(_replace_tags(_without_unseen(page), _BREAK, "\n"), _TAG, "")
    if "&" in text:
        text = html.unescape(text)
    text = text.replace("\r", "\n")
    return _LINES.sub("\n", _BLANK.sub(" ", text)).strip()


def title(page: str) -> str | None:
    opening = _TITLE.search(page)
    begin = page.find(">", opening.end()) if opening else -1
    end = re.compile(r"(?i)</title\s*>").search(page, begin) if begin >= 0 else None
    return html.unescape(page[begin + 1:end.start()]) if end else None


def language(page: str) -> str | None:
    """The last ``lang`` of the first ``html`` tag that has one."""
    gt, lang = _Next(re.compile(">"), page), _Next(_LANG, page)
    for m in _HTML.finditer(page):
        first, end = lang.after(m.end()), gt.after(m.end())
        if first is None:
            return None
        stop = end.start() if end else len(page)
        if first.start() < stop:
            return [x[1] for x in _LANG.finditer(page, first.start(), stop)][-1]
    return None


def links(page: str) -> list[str]:
    """Targets of all ``a`` tags, in order."""
    found, at = [], 0
    gt, href = _Next(re.compile(">"), page), _Next(_HREF, page)
    for m in _LINK.finditer(page):
        if m.start() < at:
            continue
        target, end = href.after(m.end()), gt.after(m.end())
        if target is None:
            break
        if end is None or target.start() <= end.start():
            found.append(html.unescape(target[1] or target[2] or target[3] or ""))
            at = target.end()
    return found


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uuid(*parts: str) -> str:
    h = hashlib.sha1("\n".join(parts).encode("utf-8", "surrogatepass")).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-{(int(h[16], 16) & 3) | 8:x}{h[17:20]}-{h[20:32]}>"


def _flat(value: str) -> str:
    return " ".join(value.split())


def _record(kind, record_id, refers_to, concurrent, uri, date, content_type, payload, block, extra) -> dict:
    raw = block.encode("utf-8")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Refers-To", refers_to)]
    if concurrent:
        fields.append(("WARC-Concurrent-To", concurrent))
    if uri is not None:
        fields.append(("WARC-Target-URI", _flat(uri)))
    fields += [("WARC-Date", date), ("WARC-Refers-To-Payload-Digest", payload), ("WARC-Block-Digest", digest(raw)),
               *extra, ("Content-Type", content_type), ("Content-Length", str(len(raw)))]
    return {"record_type": kind, "record_id": record_id, "refers_to": refers_to, "concurrent_to": concurrent,
            "target_uri": uri, "date": date, "content_type": content_type, "payload_digest": payload,
            "block_digest": digest(raw), "content_length": len(raw),
            "headers": "WARC/1.1" + CRLF + "".join(f"{k}: {v}{CRLF}" for k, v in fields), "block": block}


def derive(uri: str | None, page: str | None, date: str, record_id: str | None = None,
           source_headers: str | None = None) -> tuple[dict, dict]:
    """The metadata and the conversion record of one response."""
    page = page or ""
    payload = digest(page.encode("utf-8"))
    key = (uri or "", date, payload)
    response = record_id or _uuid("response", *key)
    extra = []
    for line in (source_headers or "").splitlines():
        name, colon, value = line.partition(":")
        if colon and name.strip().lower().startswith("warc-") and name.strip().lower() not in (
                "warc-type", "warc-record-id", "warc-refers-to", "warc-concurrent-to", "warc-target-uri", "warc-date",
                "warc-block-digest", "warc-payload-digest", "warc-refers-to-payload-digest"):
            extra.append((name.strip(), _flat(value)))
    name, lang, targets = title(page), language(page), links(page)
    fields = [("title", _flat(name)) if name is not None else None,
              ("language", lang) if lang else None,
              ("payload-bytes", str(len(page.encode("utf-8")))),
              ("outlinks", str(len(targets))), *[("outlink", _flat(link)) for link in dict.fromkeys(targets)]]
    block = "".join(f"{f[0]}: {f[1]}{CRLF}" for f in fields if f)
    meta_id = _uuid("metadata", *key)
    meta = _record("metadata", meta_id, response, None, uri, date, "application/warc-fields", payload, block, extra)
    text = _record("conversion", _uuid("conversion", *key), response, meta_id, uri, date,
                   "text/plain; charset=utf-8", payload, visible_text(page), extra)
    return meta, text


def _derive_all():
    def run(batches):
        for batch in batches:
            out, row = {c: [] for c in _COLUMNS}, []
            size = 0
            for i, values in enumerate(zip(*[batch.column(k).to_pylist() for k in range(1, batch.num_columns)])):
                for record in derive(*values):
                    row.append(i)
                    for c in _COLUMNS:
                        out[c].append(record[c])
                    size += record["content_length"]
                if size > 1 << 23:
                    yield _batch(batch, row, out)
                    out, row, size = {c: [] for c in _COLUMNS}, [], 0
            yield _batch(batch, row, out)
    return run


def _batch(batch, row, out):
    kinds = {"content_length": pa.int64()}
    return pa.record_batch([batch.column(0).take(pa.array(row, pa.int64())),
                            *[pa.array(v, kinds.get(c, pa.string())) for c, v in out.items()]],
                           names=[batch.schema.names[0], *out])


def derivatives(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
                date_col: str | None = None, record_id_col: str | None = None, headers_col: str | None = None,
                date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Two records per response, ``id_col`` and the columns of ``SCHEMA``.
    ``headers`` ends after the last header line; ``date_col``,
    ``record_id_col`` and ``headers_col`` name the source's columns if it has
    them. One pass, no shuffle."""
    def column(name):
        return F.col(name).cast("string") if name else F.lit(None).cast("string")
    base = pages.select(F.col(id_col).alias("_id"), column(uri_col).alias("uri"), column(payload_col).alias("payload"),
                        F.coalesce(column(date_col), F.lit(date)).alias("date"),
                        column(record_id_col).alias("record_id"), column(headers_col).alias("headers"))
    id_type = base.schema["_id"].dataType.simpleString()
    return base.mapInArrow(_derive_all(), f"_id {id_type}, {SCHEMA}").withColumnRenamed("_id", id_col)


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as WARC files, one per partition: the two line breaks
    that end a WARC record are the line separator of Spark's text writer."""
    (records.select(F.concat("headers", F.lit(CRLF), "block").alias("value"))
     .write.option("lineSep", CRLF * 2).option("compression", compression).text(path))
