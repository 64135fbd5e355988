"""Workbooks and checked names on files made here."""

import zipfile

import pytest

from lociq.sources import packed_files as pf

def test_workbook(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} {rel}><sheets><sheet name="A" sheetId="1" r:id="r1"/><sheet name="B" sheetId="2" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>title</t></si><si><r><t>li</t></r><r><t>ver</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData/></worksheet>")
        rows = '<row r="1"><c r="A1" t="s"><v>0</v></c></row><row r="3"><c r="A3" t="s"><v>1</v></c><c r="AB3"><v>2.5</v></c></row><row r="4"><c r="A4" t="inlineStr"><is><t>x</t></is></c><c r="AB4" t="str"><v>no</v></c></row>'
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {ns}><sheetData>{rows}</sheetData></worksheet>")
    columns = {"tissue": (0, "string"), "dose": (27, "double"), "none": (1, "long")}
    got = pf.workbook(spark, str(tmp_path / "b.xlsx"), columns, "B", skip=1)
    assert [tuple(r) for r in got.collect()] == [("liver", 2.5, None), ("x", None, None)]
    assert pf.workbook(spark, str(tmp_path / "b.xlsx"), columns).count() == 0
    with pytest.raises(Exception, match="no sheet"):
        pf.workbook(spark, str(tmp_path / "b.xlsx"), columns, "C").count()


def test_stratification(spark, tmp_path):
    (tmp_path / "d.bed").write_text("track\tx\ty\nchr1\t0\t5\nchr2\t3\t9\n")
    known = {"g": {"difficult": str(tmp_path / "d.bed")}}
    assert [tuple(r) for r in pf.stratification(spark, known, "g", "difficult").collect()] == [("chr1", 0, 5), ("chr2", 3, 9)]
    for genome, name in (("h", "difficult"), ("g", "easy")):
        with pytest.raises(ValueError, match="only"):
            pf.stratification(spark, known, genome, name)
