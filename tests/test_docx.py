"""The .docx writer/reader round trip."""

import io
import zipfile

from corpuslab.sources import docx as DX


def test_docx_paragraph_roundtrip():
    texts = ["<< user >>:", "a & b < c", "  spaced  ", ""]
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", DX._document_xml(texts))
    assert DX._paragraphs(buf.getvalue()) == texts


def test_docx_folder_scan(spark, tmp_path):
    p = spark.createDataFrame([("20_ptm_1.docx", 0, "A:"), ("20_ptm_1.docx", 1, "hello there"),
                               ("21_ptv_2.docx", 0, "B:")], "protocol_name string, para_idx long, text string")
    assert DX.write_folder(p, str(tmp_path)) == 2
    got = sorted(tuple(r) for r in DX.read_paragraphs(spark, str(tmp_path)).collect())
    assert got == [("20_ptm_1.docx", 0, "A:"), ("20_ptm_1.docx", 1, "hello there"), ("21_ptv_2.docx", 0, "B:")]


def test_tabs_and_breaks_are_kept():
    text = "a\tb\nc & d"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", DX._document_xml([text]))
    assert DX._paragraphs(buf.getvalue()) == [text]
    xml = (f'<w:document xmlns:w="{DX.W}"><w:body><w:p><w:r><w:t>one</w:t><w:tab/><w:t>two</w:t><w:cr/></w:r>'
           "<w:hyperlink><w:r><w:t>three</w:t><w:noBreakHyphen/></w:r></w:hyperlink></w:p><w:p/></w:body></w:document>")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", xml)
    assert DX._paragraphs(buf.getvalue()) == ["one\ttwo\nthree-", ""]


def test_unreadable_files_are_listed(spark, tmp_path):
    p = spark.createDataFrame([("20_ptm_1.docx", 0, "A:\tb")], "protocol_name string, para_idx long, text string")
    DX.write_folder(p, str(tmp_path))
    (tmp_path / "1_ptm_2.docx").write_bytes(b"no zip")
    with zipfile.ZipFile(tmp_path / "2_ptm_3.docx", "w") as z:
        z.writestr("other.xml", "<a/>")
    with zipfile.ZipFile(tmp_path / "3_ptm_4.docx", "w") as z:
        z.writestr("word/document.xml", "<a><b></a>")
    assert [tuple(r) for r in DX.read_paragraphs(spark, str(tmp_path)).collect()] == [("20_ptm_1.docx", 0, "A:\tb")]
    bad = {r["protocol_name"]: r["error"].split(":")[0] for r in DX.rejected_files(spark, str(tmp_path)).collect()}
    assert bad == {"1_ptm_2.docx": "BadZipFile", "2_ptm_3.docx": "KeyError", "3_ptm_4.docx": "ParseError"}


def test_fallback_table(spark, tmp_path):
    from corpuslab.sources.tables import table_or

    spark.range(3).write.parquet(str(tmp_path / "b"))
    assert table_or(spark, str(tmp_path / "a"), str(tmp_path / "b")).count() == 3
    spark.range(5).write.parquet(str(tmp_path / "a"))
    assert table_or(spark, str(tmp_path / "a"), str(tmp_path / "b")).count() == 5
