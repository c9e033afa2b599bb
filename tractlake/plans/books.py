"""Workbook inputs for the registered queries and the tests; the library only reads."""

from __future__ import annotations

import io
import zipfile

from tractlake.sources.workbooks import NS


def _cell(ref: str, v) -> str:
    if v is None:
        return ""
    s = str(v)
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return f'<c r="{ref}"><v>{s}</v></c>'
    s = s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{s}</t></is></c>'


def _letters(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def workbook_bytes(sheets) -> bytes:
    """Minimal xlsx with inline strings: ``sheets`` = [(name, header, rows)].

    Used to produce workbook inputs from table data; numbers are written as
    numeric cells, everything else as text.
    """
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        ov = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/'
                     f'vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                     for i in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.'
                   'openxmlformats.org/package/2006/content-types"><Default Extension="rels" '
                   'ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/><Override '
                   'PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-'
                   f'officedocument.spreadsheetml.sheet.main+xml"/>{ov}</Types>')
        z.writestr("_rels/.rels",
                   '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.'
                   'openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" '
                   'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
                   'officeDocument" Target="xl/workbook.xml"/></Relationships>')
        sh = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>'
                     for i, (n, _, _) in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{NS["m"]}" '
                   f'xmlns:r="{NS["r"]}"><sheets>{sh}</sheets></workbook>')
        rl = "".join(f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/'
                     f'officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>'
                     for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{NS["p"]}">'
                   f'{rl}</Relationships>')
        for i, (_, header, rows) in enumerate(sheets, 1):
            body = []
            for rn, r in enumerate([header] + list(rows), 1):
                cells = "".join(_cell(f"{_letters(j)}{rn}", v) for j, v in enumerate(r))
                body.append(f'<row r="{rn}">{cells}</row>')
            z.writestr(f"xl/worksheets/sheet{i}.xml",
                       f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{NS["m"]}">'
                       f'<sheetData>{"".join(body)}</sheetData></worksheet>')
    return buf.getvalue()
