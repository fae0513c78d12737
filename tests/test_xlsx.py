"""Real .xlsx files, written here part by part: strings of all kinds, dates by style, gaps, several sheets, damaged files."""

import zipfile
from xml.sax.saxutils import escape

from corvane.sources import files, xlsx
from pyspark.sql import functions as F

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
STYLES = f"""<styleSheet {NS}><numFmts count="2"><numFmt numFmtId="164" formatCode="dd\\-mm\\-yyyy"/><numFmt numFmtId="165" formatCode="0.0 &quot;days&quot;"/></numFmts>
<cellXfs count="5"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/><xf numFmtId="21"/></cellXfs></styleSheet>"""


def workbook(path, sheets, strings=(), *, base1904=False):
    """sheets: {name: XML of its rows}."""
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS} {rel}><workbookPr date1904="{int(base1904)}"/><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{i}" Target="{"/xl/" if i % 2 else ""}worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        z.writestr("xl/styles.xml", STYLES)
        if strings:
            z.writestr("xl/sharedStrings.xml", f"<sst {NS}>{''.join(strings)}</sst>")
        for i, rows in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {NS}><sheetData>{rows}</sheetData></worksheet>")


STRINGS = ["<si><t>Fecha</t></si>", "<si><r><t>Renta </t></r><r><t>Fija</t></r><rPh><t>no</t></rPh></si>", '<si><t xml:space="preserve">  un texto bastante largo  </t></si>']
ROWS = (
    '<row r="2"><c r="A2" t="s"><v>1</v></c></row>'
    '<row r="4"><c r="B4" t="s"><v>0</v></c><c r="C4" t="s"><v>1</v></c><c r="E4" t="inlineStr"><is><t>Divisas</t></is></c></row>'
    '<row r="5"><c r="B5" s="1"><v>45244</v></c><c r="C5" t="s"><v>2</v></c><c r="D5" t="s"><v>2</v></c><c r="E5" t="str"><v>corto</v></c></row>'
    '<row r="6"><c r="B6" s="2"><v>45245.5</v></c><c r="E6" t="inlineStr"><is><t>otro texto &amp; largo ñ</t></is></c></row>'
    '<row r="7"><c r="C7" t="s"><v>2</v></c></row>'
    '<row><c s="0"><v>7</v></c><c t="b"><v>1</v></c><c s="3"><v>12.50</v></c><c t="e"><v>#N/A</v></c><c s="4"><v>0.75</v></c></row>'
)


def test_values_and_places(tmp_path):
    workbook(tmp_path / "a.xlsx", {"One": ROWS}, STRINGS)
    got = {at: cells for _, _, at, cells in xlsx.rows_of((tmp_path / "a.xlsx").read_bytes())}
    assert got[1] == ["Renta Fija"] and got[3] == ["", "Fecha", "Renta Fija", "", "Divisas"]
    assert got[4] == ["", "2023-11-14", "un texto bastante largo", "un texto bastante largo", "corto"]
    assert got[5] == ["", "2023-11-15", "", "", "otro texto & largo ñ"]
    assert got[7] == ["7", "True", "12.5", "#N/A", "18:00:00"]
    workbook(tmp_path / "b.xlsx", {"One": '<row r="1"><c r="A1" s="1"><v>0.5</v></c><c r="B1" s="1"><v>1</v></c><c r="AB1" t="d"><v>2024-05-06T00:00:00</v></c></row>'}, base1904=True)
    ((_, _, _, cells),) = xlsx.rows_of((tmp_path / "b.xlsx").read_bytes())
    assert cells[:2] == ["12:00:00", "1904-01-02"] and cells[27] == "2024-05-06" and len(cells) == 28


def test_extraction_of_real_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    workbook(tmp_path / "d" / "Monitor PM.xlsx", {"One": ROWS, "Empty": "", "Head & less": '<row r="1"><c r="A1"><v>1</v></c></row>', "Two": ROWS.replace("45244", "45000")}, STRINGS)
    workbook(tmp_path / "d" / "2019-03-04 nothing.xlsx", {"One": '<row r="1"><c r="A1"><v>1</v></c><c r="B1"><v>2</v></c></row>'})
    workbook(tmp_path / "d" / "broken.xlsx", {"One": ROWS + "<row"}, STRINGS)
    (tmp_path / "d" / "old.xls").write_bytes(b"\xd0\xcf\x11\xe0")
    documents, chunks = files.extract(spark, f"file://{tmp_path}/d")
    docs = {r["filename"]: r for r in documents.collect()}
    rows = chunks.where("document_id = 'monitor_pm'").orderBy("position_in_doc").collect()
    assert [(r["chunk_id"], r["text"], r["page_start"], r["section_title_raw"], r["chunk_date"]) for r in rows] == [
        ("monitor_pm_0000", "[2023-11-14 - Renta Fija]\nun texto bastante largo", 1, "Renta Fija", "2023-11-14"),
        ("monitor_pm_0001", "[2023-11-15 - Divisas]\notro texto & largo ñ", 1, "Divisas", "2023-11-15"),
        ("monitor_pm_0002", "[2023-03-15 - Renta Fija]\nun texto bastante largo", 4, "Renta Fija", "2023-03-15"),
        ("monitor_pm_0003", "[2023-11-15 - Divisas]\notro texto & largo ñ", 4, "Divisas", "2023-11-15"),
    ]
    own = docs["Monitor PM.xlsx"]
    assert (own["document_date"], own["total_pages"], own["total_chunks"]) == ("2023-11-14", 4, 4) and own["extraction_warnings"] == ["a sheet without a header: Head & less"]
    nothing = docs["2019-03-04 nothing.xlsx"]
    assert (nothing["document_date"], nothing["total_pages"], nothing["total_chunks"], nothing["extraction_warnings"]) == ("2019-03-04", 0, 0, ["no cells with text"])
    assert "can't be read" in docs["old.xls"]["extraction_warnings"][0] and "can't be read" in docs["broken.xlsx"]["extraction_warnings"][0]
    assert docs["broken.xlsx"]["total_chunks"] == 2  # what came before the damage


def test_rows_come_in_batches_and_a_row_is_read_once(spark, tmp_path):
    rows = "".join(f'<row r="{i}"><c r="A{i}"><v>{i}</v></c><c r="B{i}" t="inlineStr"><is><t>narrative text {i}</t></is></c></row>' for i in range(1, 5001))
    workbook(tmp_path / "big.xlsx", {"One": rows})
    own = files.discover(spark, f"file://{tmp_path}")
    out = xlsx.sheet_rows(own)
    assert out.count() == 5000 and out.agg(F.max("row")).first()[0] == 4999
    cells = files.sheet_chunks(own)
    assert cells.count() == 4999 and cells.agg(F.max("position_in_doc")).first()[0] == 4998
    assert cells._jdf.queryExecution().executedPlan().toString().count("MapInPandas") == 1
