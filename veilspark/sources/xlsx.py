"""Excel workbooks by the standard library: sheets in workbook order, every cell as text."""
from __future__ import annotations

import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from veilspark.plans.errors import RunError

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Rows that a sheet can hold.
MAX_ROWS = 1_048_576


def _place(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def _number(text: str) -> str:
    """A number as text: whole ones below 1e15 without a fraction."""
    try:
        v = float(text)
    except ValueError:
        return text
    return str(int(v)) if v == int(v) and abs(v) < 1e15 else repr(v)


def _cell(c: ET.Element, shared: Sequence[str]) -> str:
    kind, v = c.get("t", "n"), c.find(f"{_MAIN}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
    if v is None or v.text is None:
        return ""
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return "True" if v.text == "1" else "False"
    if kind == "e":
        return f"#ERR:{v.text}"
    return v.text if kind == "str" else _number(v.text)


def _rows(f, shared: Sequence[str]) -> Iterator[list[str]]:
    for _, e in ET.iterparse(f):
        if e.tag != f"{_MAIN}row":
            continue
        out: list[str] = []
        for c in e.iter(f"{_MAIN}c"):
            at = _place(c.get("r")) if c.get("r") else len(out)
            out += [""] * (at - len(out)) + [_cell(c, shared)]
        yield out
        e.clear()


def read(path: str) -> list[tuple[str, list[str], list[list[str]]]]:
    """``(sheet, header, rows)`` of every sheet; short rows are filled, long ones cut to the header."""
    try:
        with zipfile.ZipFile(path) as z:
            names = set(z.namelist())
            shared = []
            if "xl/sharedStrings.xml" in names:
                for si in ET.parse(z.open("xl/sharedStrings.xml")).getroot().iter(f"{_MAIN}si"):
                    shared.append("".join(t.text or "" for t in si.iter(f"{_MAIN}t")))
            targets = {r.get("Id"): r.get("Target") for r in ET.parse(z.open("xl/_rels/workbook.xml.rels")).getroot()}
            out = []
            for s in ET.parse(z.open("xl/workbook.xml")).getroot().iter(f"{_MAIN}sheet"):
                t = targets[s.get(_REL)]
                rows = _rows(z.open(t.lstrip("/") if t.startswith("/") else f"xl/{t}"), shared)
                header = next(rows, None)
                if header is not None:
                    out.append((s.get("name"), header, [(r + [""] * len(header))[: len(header)] for r in rows]))
            return out
    except (zipfile.BadZipFile, KeyError, ET.ParseError, ValueError, IndexError) as e:
        raise RunError("DATA_XLSX_INVALID", f"the workbook cannot be read: {type(e).__name__}", path) from None


def _letters(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def _text(v: str) -> str:
    """Text allowed in XML 1.0."""
    return escape(re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "", v))


def write(path: str, sheets: Iterable[tuple[str, Sequence[str], Iterable[Sequence[str]]]]) -> None:
    """A workbook of text cells; rows are streamed."""
    names = []
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, header, rows in sheets:
            names.append(name)
            with z.open(f"xl/worksheets/sheet{len(names)}.xml", "w", force_zip64=True) as f:
                f.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet {ns}><sheetData>'.encode())
                for i, row in enumerate(_chain(header, rows), 1):
                    if i > MAX_ROWS:
                        raise RunError("IO_WRITE_FAILED", "a sheet cannot hold so many rows", name)
                    cells = "".join(f'<c r="{_letters(j)}{i}" t="inlineStr"><is><t xml:space="preserve">{_text(v or "")}</t></is></c>' for j, v in enumerate(row))
                    f.write(f'<row r="{i}">{cells}</row>'.encode())
                f.write(b"</sheetData></worksheet>")
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(len(names)))
        z.writestr(
            "[Content_Types].xml",
            '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{parts}</Types>',
        )
        office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        package = "http://schemas.openxmlformats.org/package/2006/relationships"
        z.writestr("_rels/.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{package}"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{package}">' + "".join(f'<Relationship Id="rId{i + 1}" Type="{office}/worksheet" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(names))) + "</Relationships>")
        z.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook {ns} xmlns:r="{office}"><sheets>' + "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(names)) + "</sheets></workbook>")


def _chain(header, rows):
    yield header
    yield from rows
