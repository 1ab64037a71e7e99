"""Mail bulletins."""

from __future__ import annotations

import re
from collections.abc import Iterator
from email import message_from_bytes, policy
from email.message import Message
from email.utils import format_datetime, parseaddr, parsedate_to_datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.functions.text import administrative
from docketflow.functions.times import bulletin_stamp
from docketflow.sources.base import parsed
from docketflow.sources.listing import decoded, html_text

ITEM = "message_id string, sender string, subject string, sent string, title string, link string, text string, shape string"
#: What links say that are no titles.
_GENERIC = re.compile(r"(?i)^(?:read (?:more|the (?:full )?(?:release|statement|story))|click here.*|learn more.*|view (?:this |the )?(?:e-?mail |message )?(?:online|in (?:a |your )?browser|as (?:a )?web ?page)|full (?:release|text|story)|more information|continue reading)\W*$")
_ANCHOR = re.compile(r"(?is)<a\b[^>]*href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>")


#: Fields that a bulletin is read by, and forms of them that need no grammar: without encoded words, comments and quotes.
_FIELDS = "message-id|from|subject|date|mime-version|content-type|content-disposition|content-transfer-encoding"
_FIELD = re.compile(rb"\n((?i:" + _FIELDS.encode() + rb"):[^\r\n]*(?:\r?\n[ \t][^\r\n]*)*)")
_HEAD = re.compile(rb"(?:[!-9;-~]+:[^\r\n]*\r?\n(?:[ \t][^\r\n]*\r?\n)*+)++(?=\r?\n)")
_ADDRESS = r"[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*"
_PLAIN = {
    "message-id": re.compile(rf"<{_ADDRESS}>"), "from": re.compile(rf"(?:[A-Za-z0-9][A-Za-z0-9 ]* ?)?<{_ADDRESS}>|{_ADDRESS}"), "subject": re.compile(r"(?:(?!=\?)[ -~])*"),
    "date": re.compile(r"[ -~]+"), "content-type": re.compile(r"(?i)text/(?:html|plain)(?:; *charset=(?:[A-Za-z0-9_-]+|\"[A-Za-z0-9_-]+\"))?"),
}


def _read(raw: bytes) -> tuple[dict, str, bool]:
    """Header fields, body and whether it is HTML. The general parser takes milliseconds for a message, most of them for the
    grammar of fields, so a message of one text part with plain fields is read without it, and without its other fields."""
    slim = raw
    if head := _HEAD.match(raw):
        slim = b"\n".join([*_FIELD.findall(b"\n" + head[0]), raw[head.end() :]])
    msg = message_from_bytes(slim)
    said = _plain(msg)
    if said is not None:
        content = msg.get_payload(decode=True).decode(msg.get_param("charset", "ASCII"), "replace")
        return said, content, msg.get_content_type() == "text/html"
    msg = message_from_bytes(raw, policy=policy.default)
    said = {"message_id": str(msg["message-id"] or ""), "sender": parseaddr(str(msg["from"] or ""))[1].lower(), "subject": " ".join(str(msg["subject"] or "").split()), "sent": str(msg["date"] or "")}
    part = msg.get_body(preferencelist=("html", "plain"))
    return said, part.get_content() if part is not None else "", part is not None and part.get_content_type() == "text/html"


def _plain(msg: Message) -> dict | None:
    """The fields of a message of one text part whose fields are plain; None for any other."""
    if msg.is_multipart() or msg.defects or "content-disposition" in msg or "content-type" not in msg:
        return None
    got = {}
    for name, form in _PLAIN.items():
        value = msg[name]
        if value is not None:
            if not isinstance(value, str) or not form.fullmatch(value := "".join(value.splitlines())):
                return None
            got[name] = value
    try:
        sent = format_datetime(parsedate_to_datetime(got["date"])) if "date" in got else ""
    except ValueError:
        return None
    return {"message_id": got.get("message-id", ""), "sender": parseaddr(got.get("from", ""))[1].lower(), "subject": " ".join(got.get("subject", "").split()), "sent": sent}


def parse_bulletin(raw: bytes) -> Iterator[dict]:
    """One item a linked release of a digest, or one item for a single release. Anchors repeat once; each
    item's text runs to the next anchor. Links that say no title (`read the full release`) are none (C19)."""
    head, body, html = _read(raw)
    found = []
    for m in _ANCHOR.finditer(body) if html else ():
        title = html_text(m[2])
        if len(title) >= 12 and not _GENERIC.match(title) and m[1].startswith(("http://", "https://")) and m[1] not in {x[0] for x in found}:
            found.append((m[1], title, m.end()))
    if len(found) >= 2:
        starts = [m for _, _, m in found]
        for (link, title, at), end in zip(found, [*starts[1:], len(body)], strict=True):
            stop = body.rfind("<a", at, end) if end < len(body) else end
            yield head | {"title": title, "link": link, "text": html_text(body[at : stop if stop > at else end]), "shape": "digest"}
        return
    yield head | {"title": head["subject"], "link": found[0][0] if found else None, "text": html_text(body) if body else "", "shape": "release"}


def field(raw: str, name: str) -> Column:
    """A field of a message's header in one line, however long the header: the first one of that name before the first blank
    line. Only this field's folded lines are joined."""
    head = F.substring_index(F.substring_index(F.col(raw).cast("string"), "\r\n\r\n", 1), "\n\n", 1)
    return F.trim(F.regexp_replace(F.regexp_extract(head, rf"(?ism)^{name}:(.*?)(?=\r?\n[^ \t]|\z)", 1), r"\r?\n[ \t]+", " "))


def bulletins(rows: DataFrame, raw: str, keep: list[str], allowed: DataFrame | None = None, sender: str = "sender") -> DataFrame:
    """Items of messages from allowed senders (case folded), each with the stamp in its text.

    Sender and subject are read from the header first, so other mail, and mail that manages a subscription, is never
    parsed. The stamp is the item's own clock time, as publishers write it into bulletins; null where there is none."""
    if allowed is not None:
        address = F.lower(F.regexp_extract(field(raw, "From"), r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+)", 1))
        rows = rows.withColumn("_from", address).join(allowed.select(F.lower(sender).alias("_from")).distinct(), "_from", "left_semi").drop("_from")
    rows = rows.filter(~F.coalesce(administrative(field(raw, "Subject")), F.lit(False)))
    found = parsed(rows, raw, keep, ITEM, parse_bulletin)
    return found.withColumn("stamped", bulletin_stamp("text"))


def since(rows: DataFrame, uid: str, last_uid: int, validity: int, last_validity: int) -> DataFrame:
    """K4: messages after the cursor; all of them when the mailbox was renumbered."""
    return rows if validity != last_validity else rows.filter(F.col(uid) > last_uid)


__all__ = ["bulletins", "decoded", "parse_bulletin", "since"]
