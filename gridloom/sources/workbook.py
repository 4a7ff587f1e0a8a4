"""Workbooks (.xlsx) as bytes: sheets, cells with formula and stored value, names, calculation settings; and a plain writer."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET
from xml.parsers import expat
from xml.sax.saxutils import escape, quoteattr

from ..functions.formula import column_letters, column_number, shifted

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Built-in number formats that show a date or time.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])


def _rels(z: zipfile.ZipFile) -> dict[str, str]:
    tree = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    return {r.get("Id"): "xl/" + r.get("Target").lstrip("/").removeprefix("xl/") for r in tree}


def sheets(content: bytes) -> list[tuple[str, str]]:
    """(name, part) of the sheets in order."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        rels, book = _rels(z), ET.fromstring(z.read("xl/workbook.xml"))
        return [(s.get("name"), rels[s.get(f"{_REL}id")]) for s in book.iter(f"{_MAIN}sheet")]


def names(content: bytes) -> list[tuple[str | None, str, str]]:
    """(sheet or None, upper-cased name, target)."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        book = ET.fromstring(z.read("xl/workbook.xml"))
    order = [s.get("name") for s in book.iter(f"{_MAIN}sheet")]
    return [(order[int(n.get("localSheetId"))] if n.get("localSheetId") else None, n.get("name").upper(), n.text or "") for n in book.iter(f"{_MAIN}definedName")]


def calculation(content: bytes) -> dict:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        c = ET.fromstring(z.read("xl/workbook.xml")).find(f"{_MAIN}calcPr")
    c = {} if c is None else c.attrib
    return {"iterate": c.get("iterate") in ("1", "true"), "count": int(c.get("iterateCount", 100)), "delta": float(c.get("iterateDelta", 0.001))}


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{_MAIN}t"))


def _date_styles(z: zipfile.ZipFile) -> list[bool]:
    if "xl/styles.xml" not in z.namelist():
        return []
    tree = ET.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): bool(re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "").lower()))) for f in tree.iter(f"{_MAIN}numFmt")}
    xfs = tree.find(f"{_MAIN}cellXfs")
    return [(k := int(x.get("numFmtId", 0))) in DATE_FORMATS or own.get(k, False) for x in (xfs if xfs is not None else [])]


def _held(z: zipfile.ZipFile, part: str) -> bool:
    """Whether a sheet has to be read whole before its cells are known: its cells aren't in order, or formulas span cells."""
    last, held = (0, 0), False

    def start(tag: str, attributes: dict) -> None:
        nonlocal last, held
        if tag == f"{_MAIN[1:-1]} c":
            place = _place(attributes["r"])
            held, last = held or place <= last, place
        elif tag == f"{_MAIN[1:-1]} f":
            held = held or attributes.get("t") == "array"

    parser = expat.ParserCreate(namespace_separator=" ")
    parser.StartElementHandler = start
    with z.open(part) as f:
        parser.ParseFile(f)
    return held


def _place(a1: str) -> tuple[int, int]:
    m = re.fullmatch(r"([A-Z]+)(\d+)", a1)
    return int(m[2]), column_number(m[1])


def _elements(z: zipfile.ZipFile, part: str) -> Iterator:
    """The elements of a sheet's cells one by one; what was read is let go."""
    above: list = []
    with z.open(part) as f:
        for event, el in ET.iterparse(f, ("start", "end")):
            if event == "start":
                above.append(el)
                continue
            above.pop()
            if el.tag == f"{_MAIN}c":
                yield el
            if above and el.tag in (f"{_MAIN}c", f"{_MAIN}row"):
                above[-1].remove(el)


def each_cell(content: bytes) -> Iterator[dict]:
    """A dictionary for each populated cell: sheet, sheet_idx, row, col, a1, formula, is_array, kind, number, text.

    kind: num, text, bool, date, error or blank (a formula without stored value). A shared formula is written out for
    each of its cells; members of an array formula carry its formula. Only sheets with array formulas, or whose cells
    aren't in order, are held whole.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        strings = [_text(s) for s in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")] if "xl/sharedStrings.xml" in z.namelist() else []
        dates = _date_styles(z)
        for i, (name, part) in enumerate(sheets(content)):
            shared: dict[str, tuple[str, int, int]] = {}
            arrays: list[tuple[int, int, int, int, str]] = []
            found: dict[tuple[int, int], dict] = {}
            held = _held(z, part)
            for c in _elements(z, part):
                row, col = _place(c.get("r"))
                f, v, kind = c.find(f"{_MAIN}f"), c.find(f"{_MAIN}v"), c.get("t", "n")
                formula, is_array = None, False
                if f is not None:
                    formula = f.text
                    if f.get("t") == "shared":
                        if formula:
                            shared[f.get("si")] = (formula, row, col)
                        elif f.get("si") in shared:
                            base, r0, c0 = shared[f.get("si")]
                            formula = shifted(base, row - r0, col - c0)
                    elif f.get("t") == "array" and formula:
                        is_array = True
                        a, _, b = f.get("ref", c.get("r")).partition(":")
                        (r1, c1), (r2, c2) = (_place(x or a) for x in (a, b))
                        arrays.append((r1, c1, r2, c2, formula))
                raw = _text(c) if kind == "inlineStr" else v.text if v is not None else None
                value = {"kind": "blank", "number": None, "text": None}
                if raw is not None:
                    if kind in ("s", "str", "inlineStr"):
                        value = {"kind": "text", "number": None, "text": strings[int(raw)] if kind == "s" else raw}
                    elif kind == "e":
                        value = {"kind": "error", "number": None, "text": raw}
                    elif kind == "b":
                        value = {"kind": "bool", "number": float(raw), "text": None}
                    else:
                        style = int(c.get("s", 0))
                        value = {"kind": "date" if style < len(dates) and dates[style] else "num", "number": float(raw), "text": None}
                if formula is None and raw is None:
                    continue
                cell = {"sheet": name, "sheet_idx": i, "row": row, "col": col, "a1": c.get("r"), "formula": "=" + formula if formula else None, "is_array": is_array, **value}
                if held:
                    found[row, col] = cell
                else:
                    yield cell
            for r1, c1, r2, c2, formula in arrays:
                for r in range(r1, r2 + 1):
                    for k in range(c1, c2 + 1):
                        cell = found.setdefault((r, k), {"sheet": name, "sheet_idx": i, "row": r, "col": k, "a1": f"{column_letters(k)}{r}", "kind": "blank", "number": None, "text": None})
                        cell |= {"formula": "=" + formula, "is_array": True}
            yield from (found[k] for k in sorted(found))


def cells(content: bytes) -> list[dict]:
    """each_cell in a list."""
    return list(each_cell(content))


def _value(v: object) -> str:
    if isinstance(v, bool):
        return f' t="b"><v>{int(v)}</v>'
    if isinstance(v, int | float):
        return f"><v>{v!r}</v>"
    return f' t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is>'


def _cell(a1: str, v: object) -> str:
    formula = v[0] if isinstance(v, tuple) else v if isinstance(v, str) and v.startswith("=") else None
    if formula is None:
        return f'<c r="{a1}"{_value(v)}</c>'
    stored = v[1] if isinstance(v, tuple) else None
    kind = ' t="str"' if isinstance(stored, str) else ' t="b"' if isinstance(stored, bool) else ""
    tail = "" if stored is None else f"<v>{escape(str(int(stored) if isinstance(stored, bool) else stored))}</v>"
    return f'<c r="{a1}"{kind}><f>{escape(formula[1:])}</f>{tail}</c>'


class Writer:
    """A workbook that is written cell by cell: sheets one after another, their cells by row, then by column."""

    def __init__(self) -> None:
        self.out, self.sheets, self.part, self.row, self.text = io.BytesIO(), [], None, None, []
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_DEFLATED)
        self.zip.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/></Types>')

    def sheet(self, name: str) -> None:
        self.end()
        self.sheets.append(name)
        self.part = self.zip.open(f"xl/worksheets/sheet{len(self.sheets)}.xml", "w", force_zip64=True)  # its size isn't known yet
        self.text.append(f'<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>')

    def cell(self, row: int, col: int, v: object) -> None:
        if row != self.row:
            self.text.append(("" if self.row is None else "</row>") + f'<row r="{row}">')
            self.row = row
        self.text.append(_cell(f"{column_letters(col)}{row}", v))
        if len(self.text) > 4096:
            self.flush()

    def flush(self) -> None:
        self.part.write("".join(self.text).encode())
        self.text.clear()

    def end(self) -> None:
        if self.part is not None:
            self.text.append(("" if self.row is None else "</row>") + "</sheetData></worksheet>")
            self.flush()
            self.part.close()
            self.part = self.row = None

    def content(self, defined: dict[str, str] | None = None) -> bytes:
        self.end()
        n = len(self.sheets)
        self.zip.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml" Type="x"/>' for i in range(1, n + 1)) + "</Relationships>")
        listed = "".join(f'<sheet name={quoteattr(s)} sheetId="{i}" r:id="r{i}"/>' for i, s in enumerate(self.sheets, 1))
        given = "<definedNames>" + "".join(f"<definedName name={quoteattr(k)}>{escape(v)}</definedName>" for k, v in (defined or {}).items()) + "</definedNames>"
        self.zip.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_REL[1:-1]}"><sheets>{listed}</sheets>{given}</workbook>')
        self.zip.close()
        return self.out.getvalue()


def write(book: dict[str, dict[str, object]], defined: dict[str, str] | None = None) -> bytes:
    """Bytes of a workbook from sheet -> cell -> value; text that begins with = is a formula, (formula, value) stores both."""
    w = Writer()
    for name, own in book.items():
        w.sheet(name)
        for a1 in sorted(own, key=_place):
            w.cell(*_place(a1), own[a1])
    return w.content(defined)


def masked(content: bytes, keep) -> bytes:
    """The workbook with only those cells that keep(sheet, row, col) names; formulas in them become their stored values."""
    parts, out = dict((p, s) for s, p in sheets(content)), io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as z, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as w:
        for item in z.namelist():
            data = z.read(item)
            if item in parts:
                tree = ET.fromstring(data)
                for row in tree.iter(f"{_MAIN}row"):
                    for c in list(row):
                        m = re.fullmatch(r"([A-Z]+)(\d+)", c.get("r"))
                        if not keep(parts[item], int(m[2]), column_number(m[1])):
                            row.remove(c)
                        elif (f := c.find(f"{_MAIN}f")) is not None:
                            c.remove(f)
                data = ET.tostring(tree)
            elif item == "xl/calcChain.xml":
                continue
            elif item.startswith("xl/charts/"):  # what charts remember of their cells
                data = re.sub(rb"<(\w+:)?(numCache|strCache|multiLvlStrCache)\b.*?</(\w+:)?\2>", b"", data, flags=re.S)
            w.writestr(item, data)
    return out.getvalue()


def iso(serial: float) -> str:
    return (datetime(1899, 12, 30) + timedelta(days=serial)).isoformat()
