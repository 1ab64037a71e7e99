"""Publication packages: XML issues, bills and laws, ZIP packages."""

from __future__ import annotations

import io
import itertools
import re
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from operator import itemgetter
from xml.etree import ElementTree as ET

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.sources.base import parsed
from docketflow.sources.listing import decoded, html_text

RECORD = "granule_id string, doc_type string, title string, agency string, metadata map<string, string>, text string"
#: Document elements of an issue, bill types longest first, pages' sections, printed marks.
ISSUE_DOCS = ("RULE", "PRORULE", "NOTICE", "PRESDOCU")
BILL_TYPES = ("hconres", "sconres", "hjres", "sjres", "hres", "sres", "hr", "s")
SECTION_OF_PAGE = {"S": "SENATE", "H": "HOUSE", "E": "EXTENSIONS", "D": "DAILYDIGEST"}
#: Fixed values of case packages: the metadata member's name, and the parts of it that hold fields.
MODS_NAME, MODS_SECTIONS = re.compile(r"(^|/)mods\.xml$"), ("extension", "originInfo", "titleInfo")
OPINION, ENDS_NUMBER, LAST = re.compile(r"(?is)(?:.*/)?pdf/([^/]*)\.pdf$"), re.compile(r"(?:^|-)([0-9]{1,4000})$"), 10**38
#: A mods.xml in its plainest form: sections of fields that hold characters alone, in the case and in its opinions.
ODD, FIELD, ITEM = re.compile(r"[^\t\n\r -~]"), re.compile(r"<([A-Za-z]++)>([^<>&]*+)</"), '<relatedItem type="constituent">'
MODS_SECTION = rf"\s*+<({'|'.join(MODS_SECTIONS)})>(?:\s*+<([A-Za-z]++)>[^<>&]*+</\{{}}>)++\s*+</\{{}}>"
MODS = re.compile(rf'\s*+<mods(?: xmlns="http://www\.loc\.gov/mods/v3")?+>(?:\s*+{ITEM}(?:{MODS_SECTION.format(2, 1)})*+\s*+</relatedItem>|{MODS_SECTION.format(4, 3)})*+\s*+</mods>\s*+')
#: ZIP records: of a member, of a member in the directory, and the end of the directory.
LOCAL, CENTRAL, END = struct.Struct("<4s5H3L2H"), struct.Struct("<4s6H3L5H2L"), struct.Struct("<4s4H2LH")
#: Of a record of the directory: its mark; version, flags and method; sum and sizes; what else it holds; offset. Plain ones of the second.
READ, PLAIN = struct.Struct("<4s2x6s4x3LH6s6xL"), {struct.pack("<3H", *x) for x in itertools.product((10, 20), (0, 0x800), (0, 8))}
GRANULE = re.compile(r"CREC-(\d{4}-\d{2}-\d{2})-pt(\d+)-Pg([SHED])(\d+)(?:-(\d+))?\.htm$")


def _flat(e: ET.Element | None, skip: tuple[str, ...] = ()) -> str:
    """The words of an element, without the skipped ones."""
    if e is None:
        return ""
    if not len(e):  # most elements
        return " ".join((("" if e.tag.rpartition("}")[2] in skip else e.text or "") + (e.tail or "")).split())
    parts: list[str] = []

    def walk(x: ET.Element) -> None:
        if x.tag.rpartition("}")[2] in skip:
            parts.append(x.tail or "")
            return
        parts.append(x.text or "")
        for c in x:
            walk(c)
            parts.append(" ")
        parts.append(x.tail or "")

    walk(e)
    return " ".join("".join(parts).split())


def parse_issue(body: bytes | str) -> Iterator[dict]:
    """A5: every rule, proposed rule, notice and presidential document of an issue, wherever it is nested;
    documents without a citable number are left out."""
    for doc in ET.fromstring(body).iter():
        if doc.tag not in ISSUE_DOCS:
            continue
        number = re.search(r"FR Doc\.\s*([0-9A-Za-z-]+)", _flat(doc.find(".//FRDOC")))
        if not number:
            continue
        title = doc.find(".//SUBJECT") if doc.find(".//SUBJECT") is not None else doc.find(".//HD")
        graphics = [_flat(g) for g in doc.iter("GID")]
        meta = {"pages": " ".join(p.get("P") or _flat(p) for p in doc.iter("PRTPAGE")), "graphics": str(len(graphics)), "graphic_ids": " ".join(graphics)}
        for label in ("ACTION", "SUMMARY", "DATES"):
            if doc.find(f".//{label[:3]}") is not None or doc.find(f".//{label}") is not None:
                found = doc.find(f".//{label}") if doc.find(f".//{label}") is not None else doc.find(f".//{label[:3]}")
                meta[label.lower()] = re.sub(rf"^{label}:\s*", "", _flat(found), flags=re.I)
        yield {"granule_id": number[1], "doc_type": doc.tag, "title": _flat(title) or None, "agency": _flat(doc.find(".//AGENCY")) or None, "metadata": list(meta.items()), "text": _flat(doc, ("PRTPAGE", "GPH"))}


def parse_inventory(body: bytes | str) -> Iterator[dict]:
    """Page marks and graphics of one document in order; a mark has no graphic id, a graphic no page yet."""
    for e in ET.fromstring(body).iter():
        if e.tag == "PRTPAGE":
            yield {"gid": None, "page": e.get("P") or _flat(e) or None}
        elif e.tag == "GID" and (gid := _flat(e)):
            yield {"gid": gid, "page": None}


def parse_bill(body: bytes | str) -> Iterator[dict]:
    """One bill: its title, stage, distinct sponsors in order, and text without the metadata element."""
    root = ET.fromstring(body)
    stage = next((v for k, v in root.attrib.items() if k.endswith("stage")), None)
    sponsors = list(dict.fromkeys(_flat(s) for s in root.iter() if s.tag.rpartition("}")[2] in ("sponsor", "cosponsor")))
    title = next((_flat(t) for t in root.iter() if t.tag.rpartition("}")[2] in ("official-title", "title")), None)
    yield {"granule_id": "", "doc_type": stage, "title": title, "agency": None, "metadata": [("sponsors", "; ".join(sponsors))], "text": _flat(root, ("metadata",))}


def parse_law(body: bytes | str) -> Iterator[dict]:
    """One law with its number, citations, approval day and stated type; a body that isn't XML is taken as plain text."""
    raw = decoded(body) if isinstance(body, bytes) else body
    try:
        root = ET.fromstring(raw)
    except ET.ParseError:
        yield {"granule_id": "", "metadata": [("format", "txt")], "text": " ".join(raw.split())}
        return
    meta = next((e for e in root if e.tag.rpartition("}")[2] in ("meta", "metadata")), None)
    said: dict[str, list[str]] = {}
    for e in meta if meta is not None else ():
        if words := _flat(e):
            said.setdefault(e.tag.rpartition("}")[2], []).append(words)
    one = {"law_number": "docNumber", "approved_date": "approvedDate", "law_type": "type"}
    metadata = [(k, said[v][0]) for k, v in one.items() if v in said]
    if "citableAs" in said:
        metadata.append(("citations", "; ".join(said["citableAs"])))
    yield {"granule_id": "", "title": said.get("title", [None])[0], "metadata": metadata, "text": " ".join(" ".join(root.itertext()).split())}


def parse_record_zip(body: bytes) -> Iterator[dict]:
    """Granule pages of a daily package in order of issue, part, page and sequence; the class from the page's letter."""
    with zipfile.ZipFile(io.BytesIO(body)) as z:
        found = [(m, n) for n in z.namelist() if (m := GRANULE.search(n))]
        for m, name in sorted(found, key=lambda x: (x[0][1], int(x[0][2]), x[0][3], int(x[0][4]), int(x[0][5] or 0))):
            page = decoded(z.read(name))
            title = re.search(r"<title>(.*?)</title>", page, re.S | re.I)
            title_text = re.sub(r"^Congressional Record\W*", "", " ".join(title[1].split())) if title else None
            yield {"granule_id": name.rpartition("/")[2][:-4], "doc_type": SECTION_OF_PAGE[m[3]], "title": title_text, "agency": None, "metadata": [("page", m[3] + m[4])], "text": html_text(re.sub(r"(?is)<title>.*?</title>", "", page))}


def stored_zip(members: Iterable[tuple[str, bytes]]) -> bytes:
    """A ZIP of members with ASCII names, not compressed, without times: the bytes that zipfile writes for them."""
    body, directory, n = bytearray(), bytearray(), 0
    for name, content in members:
        name, at = name.encode("ascii"), len(body)
        head = (20, 0, 0, 0, 33, zlib.crc32(content), len(content), len(content), len(name), 0)  # 33 is the first day of 1980
        body += LOCAL.pack(b"PK\3\4", *head) + name + content
        directory += CENTRAL.pack(b"PK\1\2", 3 << 8 | 20, *head, 0, 0, 0, 0o600 << 16, at) + name
        n += 1
    return bytes(body + directory + END.pack(b"PK\5\6", 0, 0, n, n, len(directory), len(body), 0))


def plain_zip(body: bytes) -> list[tuple[str, bytes]] | None:
    """Names and contents of a ZIP whose members follow each other without gaps, extra fields or comments, under different
    ASCII names, and are all intact; None for any other body, which zipfile is left to judge. Opening a ZIP and its members
    with zipfile takes many times as long as reading what short ones hold."""
    end = len(body) - END.size
    if end < 0 or body[end - 20 : end - 16] == b"PK\6\7":  # the latter is of larger ZIPs
        return None
    mark, disk, first, here, n, size, start, comment = END.unpack_from(body, end)
    if mark != b"PK\5\6" or disk or first or here != n or comment or start + size != end or n * (CENTRAL.size + LOCAL.size) > end:
        return None
    at, begin, out = start, 0, {}
    for _ in range(n):
        if at + CENTRAL.size > end:
            return None
        mark, kind, crc, packed, whole, long, other, offset = READ.unpack_from(body, at)
        name = body[at + CENTRAL.size : at + CENTRAL.size + long]
        inside = begin + LOCAL.size + long
        after = inside + packed
        if mark != b"PK\1\2" or kind not in PLAIN or other != bytes(6) or offset != begin or after > start or not name.isascii() or b"\0" in name:
            return None
        if body[begin:inside] != b"PK\3\4" + body[at + 6 : at + 32] + name:
            return None
        content = body[inside:after]
        if kind[4]:
            inflate = zlib.decompressobj(-zlib.MAX_WBITS)
            try:
                content = inflate.decompress(content, whole + 1)
            except zlib.error:
                return None
            if not inflate.eof or inflate.unused_data:
                return None
        if len(content) != whole or zlib.crc32(content) != crc:
            return None
        out[name.decode("ascii")] = content
        at, begin = at + CENTRAL.size + long, after
    return list(out.items()) if at == end and begin == start and len(out) == n else None


def parse_members(body: bytes, wanted: str) -> Iterator[dict]:
    """Every member of a ZIP: its name, its bytes where the name matches `wanted`, and a note if it can't be read."""
    find = re.compile(wanted).search
    for name, content, note in _members(body):
        yield {"name": name, "content": content if find(name) else None, "note": note}


def _members(body: bytes) -> Iterator[tuple[str, bytes | None, str | None]]:
    plain = plain_zip(body) if isinstance(body, bytes) else None
    if plain is not None:
        yield from ((name, content, None) for name, content in plain)
        return
    with zipfile.ZipFile(io.BytesIO(body)) as z:
        for name in z.namelist():
            content = note = None
            try:
                content = z.read(name)  # all of them, as that checks their sums
            except (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError, EOFError, OSError) as e:
                note = type(e).__name__
            yield name, content, note


def plain_mods(body: bytes) -> tuple[dict[str, str], dict[str, dict[str, str]]] | None:
    """What `parse_mods` gives for a mods.xml in its plainest form, without an XML parser; None for any other."""
    text = body.decode("ascii") if body.isascii() else ""
    spaced = not text.isprintable()
    if spaced and ODD.search(text) or not MODS.fullmatch(text):
        return None
    fields = FIELD.findall
    if spaced or "  " in text or "> " in text or " <" in text:
        fields = lambda x: [(k, " ".join(v.split())) for k, v in FIELD.findall(x)]
    first, *items = text[text.index(">") + 1 : text.rindex("</")].split(ITEM)
    case, own = dict(fields(first)), {}
    for item in items:
        said, _, rest = item.partition("</relatedItem>")
        said = dict(fields(said))
        case.update(fields(rest))
        if said.get("accessId"):
            own.setdefault(said["accessId"], said)
    return case, own


def parse_mods(body: bytes) -> tuple[dict[str, str], dict[str, dict[str, str]]]:
    """The fields that a mods.xml states for the case, and for each of its opinions by access id (the first with that id)."""
    plain = plain_mods(body)
    if plain is not None:
        return plain

    def stated(holder: ET.Element) -> dict[str, str]:
        sections = (e for e in holder if e.tag.rpartition("}")[2] in MODS_SECTIONS)
        return {field.tag.rpartition("}")[2]: _flat(field) for section in sections for field in section}

    root = ET.fromstring(body)
    own: dict[str, dict[str, str]] = {}
    for e in root:
        if (e.tag.endswith("}relatedItem") or e.tag == "relatedItem") and e.get("type") == "constituent":
            said = stated(e)
            if said.get("accessId"):
                own.setdefault(said["accessId"], said)
    return stated(root), own


def parse_case(body: bytes) -> Iterator[dict]:
    """The opinions (PDF members) of a case package in order of the number that ends their name, those without one last:
    each with what its package's mods.xml states for the case and for itself, and why either can't be read."""
    is_mods = MODS_NAME.search
    every = [(name, content if is_mods(name) else None, note) for name, content, note in _members(body)]
    mods = next((m for m in every if m[1] is not None or m[2] and is_mods(m[0])), None)
    case, own, why = None, {}, None
    if mods is None:
        why = "mods.xml missing"
    elif mods[2]:
        why = f"mods.xml unreadable: {mods[2]}"
    else:
        try:
            case, own = parse_mods(mods[1])
        except Exception as e:  # a note of the opinions, not of the package
            why = f"mods.xml unreadable: {type(e).__name__}"
    case = None if case is None else list(case.items())
    found = []
    for name, _, note in every:
        if opinion := OPINION.match(name):
            stem = opinion[1]
            number = ENDS_NUMBER.search(stem)
            said = own.get(stem)
            found.append((min(int(number[1]), LAST) if number else LAST, stem, {"granule_id": stem, "case": case, "own": None if said is None else list(said.items()), "why": why or (f"unreadable member: {note}" if note else None)}))
    found.sort(key=itemgetter(0, 1))
    return (x for _, _, x in found)


def issue(rows: DataFrame, body: str, keep: list[str]) -> DataFrame:
    return parsed(rows, body, keep, RECORD, parse_issue)


def inventory(rows: DataFrame, body: str, package: str, member: str) -> DataFrame:
    """The graphics of every package in document order (package, member, pos, gid, page, error), each with the last
    page printed before it, be that in an earlier member of its package; null before the first. A member that can't be
    read is one row with its error and prints no page."""
    marks = parsed(rows, body, [package, member], "gid string, page string", parse_inventory)
    order = W.partitionBy(package).orderBy(F.asc_nulls_first(member), F.asc_nulls_first("pos")).rowsBetween(W.unboundedPreceding, 0)
    place = F.count("gid").over(W.partitionBy(package, member).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)) - 1  # of one order with the other
    marks = marks.withColumns({"_page": F.last("page", ignorenulls=True).over(order), "_place": place.cast("int")})
    read = F.col("error").isNull()
    return marks.filter("gid IS NOT NULL OR error IS NOT NULL").select(package, member, F.when(read, F.col("_place")).alias("pos"), "gid", F.when(read, F.col("_page")).alias("page"), "error")


def bills(rows: DataFrame, body: str, keep: list[str]) -> DataFrame:
    return parsed(rows, body, keep, RECORD, parse_bill)


def laws(rows: DataFrame, body: str, keep: list[str], package: str = "package_id") -> DataFrame:
    """Laws; the class by the stated type or the package id (one of `keep`), as the text may cite laws of either."""
    out = parsed(rows, body, keep, RECORD, parse_law)
    said, code = F.lower(F.coalesce(F.col("metadata")["law_type"], F.lit(""))), F.col(package)
    plain = F.coalesce(F.col("metadata")["format"] == "txt", F.lit(False))
    private = F.when(plain, ~F.contains(code, F.lit("publ"))).otherwise(said.startswith("private") | F.contains(code, F.lit("pvtl")))
    return out.withColumn("doc_type", F.when(F.col("error").isNull(), F.when(private, "PRIVATE").otherwise("PUBLIC")))


def record_zips(rows: DataFrame, body: str, keep: list[str]) -> DataFrame:
    return parsed(rows, body, keep, RECORD, parse_record_zip)


def members(rows: DataFrame, body: str, keep: list[str], wanted: str = "") -> DataFrame:
    """The member table of ZIPs: one row a member, or one with an error for a body that is no ZIP."""
    return parsed(rows, body, keep, "name string, content binary, note string", lambda x: parse_members(x, wanted))


def case_zips(rows: DataFrame, body: str, keep: list[str], package: str = "package_id", texts: str | None = None) -> DataFrame:
    """One row an opinion (a PDF member) of every case package, in order of the number that ends its name (names
    without one last), with the metadata of its stem: category, whether a precedent, and text.

    A package is read once, and its members meet its metadata where it is read, so nothing is shuffled. `package` names a
    column of `keep` with its id. `texts` names a column (one of `keep`) that maps a stem to the words of its PDF, as text
    inside PDF needs a library outside this one; an opinion that isn't in it has the empty text. Whatever is missing or
    can't be read is a note of the opinions it concerns and stops nothing; a body that is no ZIP is one row with its error.
    """
    opinions = parsed(rows, body, keep, "granule_id string, case map<string, string>, own map<string, string>, why string", parse_case)
    text = F.try_element_at(F.col(texts), F.col("granule_id")) if texts else F.lit(None).cast("string")
    why = [F.col("why"), F.when(text.isNull(), "no text")]
    fields = {"court_type": F.col("case")["courtType"], "court_code": F.col("case")["courtCode"], "court_name": F.col("own")["courtName"], "case_number": F.col("case")["caseNumber"]}
    fields |= {"case_type": F.col("case")["caseType"], "date_filed": F.col("own")["dateIssued"], "docket_text": F.col("own")["docketText"], "extraction_note": F.coalesce(*why)}
    metadata = F.map_filter(F.create_map(*(x for k, v in fields.items() for x in (F.lit(k), v))), lambda _, v: F.coalesce(v, F.lit("")) != "")
    code = F.coalesce(fields["court_code"], F.regexp_extract(package, r"^USCOURTS-([a-z0-9]+)-", 1))
    read = lambda c: F.when(F.col("error").isNull(), c)
    return opinions.select(
        *keep, "granule_id", read(court_category(F.coalesce(fields["court_type"], F.lit("")), code)).alias("doc_type"), F.col("case")["title"].alias("title"), F.lit(None).cast("string").alias("agency"),
        read(metadata).alias("metadata"), read(F.coalesce(text, F.lit(""))).alias("text"), "pos", "error", precedential(F.col("own")["docketText"]).alias("precedential"),
    )


def bill_id(package: Column) -> dict[str, Column]:
    """Congress, type (longest first), number, version and chamber of BILLS-119hconres12rh."""
    p = rf"^BILLS-(\d+)({'|'.join(BILL_TYPES)})(\d+)([a-z]+\d?)$"
    kind = F.regexp_extract(package, p, 2)
    return {"congress": F.regexp_extract(package, p, 1), "type": kind, "number": F.regexp_extract(package, p, 3), "version": F.regexp_extract(package, p, 4), "chamber": F.when(kind.startswith("h"), "house").when(kind.startswith("s"), "senate")}


def court_category(kind: Column, code: Column) -> Column:
    """The court's category from its metadata, else from its code. Names and codes are fixed values of the format."""
    k, c = F.lower(kind), F.lower(code)
    return F.when(k.contains("appellate"), "APPELLATE").when(k.contains("bankruptcy"), "BANKRUPTCY").when(k.contains("national"), "NATIONAL").when(k.contains("district"), "DISTRICT").when(c.rlike(r"^ca(?:\d+|dc|fc)$"), "APPELLATE").when(c.isin("cit", "uscfc", "jpml"), "NATIONAL").when(c.endswith("b"), "BANKRUPTCY").otherwise("DISTRICT")


def precedential(text: Column) -> Column:
    """Whether an opinion says it is a precedent; the denial is looked for first. Null where it says neither."""
    return F.when(text.rlike(r"(?iu)\b(?:non-?precedential|not\s+(?:for\s+publication|precedential)|unpublished)\b"), False).when(text.rlike(r"(?iu)\b(?:precedential|for publication|published)\b"), True)


def graphic_class(gid: Column) -> Column:
    """Section-coded graphics are substantive. The pattern is a fixed value of the format."""
    return F.when(gid.rlike(r"^E[A-Z]\d{2}[A-Z]{2}\d{2}\.\d+$"), "substantive").otherwise("decorative")
