"""``.docx`` transcript folders.

Reading: ``binaryFile`` with a ``*.docx`` glob gives one row per file; a
``mapInPandas`` step opens each file's zip, parses ``word/document.xml``
with the standard library and emits one row per body paragraph (the text of
its runs, tabs and line breaks included), in document order. A file that
can't be read gives one row in the rejected-files table, with the reason.

Writing (to make folders from tables, e.g. for tests): one group per file,
each written by ``applyInPandas`` as a minimal WordprocessingML package
through the file system that the folder's address names, under a name of its
own first, so that a retried task replaces a whole file.
"""

from __future__ import annotations

import io
import os
import re
import uuid
import zipfile
import zlib
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
PARA_SCHEMA = "protocol_name string, para_idx long, text string"
#: Elements of a run that stand for a sign.
_MARKS = {f"{{{W}}}tab": "\t", f"{{{W}}}br": "\n", f"{{{W}}}cr": "\n", f"{{{W}}}noBreakHyphen": "-"}

# FIXED VALUES: the parts of a minimal .docx package
_CT = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
       '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
       '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
       '<Default Extension="xml" ContentType="application/xml"/>'
       '<Override PartName="/word/document.xml" '
       'ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>')
_RELS = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
         '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
         '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
         'officeDocument" Target="word/document.xml"/></Relationships>')


def _text(paragraph) -> str:
    """Text of a paragraph's runs; a tab is a tab, a break a line end."""
    out = []
    for e in paragraph.iter():
        if e.tag == f"{{{W}}}t":
            out.append(e.text or "")
        else:
            out.append(_MARKS.get(e.tag, ""))
    return "".join(out)


def _paragraphs(content: bytes) -> list[str]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ET.fromstring(z.read("word/document.xml"))
    body = root.find(f"{{{W}}}body")
    if body is None:
        return []
    return [_text(p) for p in body.findall(f"{{{W}}}p")]


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(protocol_name, para_idx, text, error): every paragraph of every
    ``.docx`` in ``folder``, and a row with ``error`` alone for each file
    that can't be read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(folder)
             .select("path", "content"))

    def parse(batches):
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                name = os.path.basename(path)
                try:
                    out += [(name, i, t, None) for i, t in enumerate(_paragraphs(bytes(content)))]
                except (zipfile.BadZipFile, KeyError, ET.ParseError, NotImplementedError, EOFError, zlib.error, RuntimeError) as e:
                    out.append((name, None, None, f"{type(e).__name__}: {e}"))
            frame = pd.DataFrame(out, columns=["protocol_name", "para_idx", "text", "error"])
            yield frame.astype({"para_idx": "Int64"})

    return files.mapInPandas(parse, f"{PARA_SCHEMA}, error string")


def read_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    """(protocol_name, para_idx, text) of the files that can be read."""
    return read_files(spark, folder).filter("error IS NULL").drop("error")


def rejected_files(spark: SparkSession, folder: str) -> DataFrame:
    """(protocol_name, error) of the files that can't be read."""
    return read_files(spark, folder).filter("error IS NOT NULL").select("protocol_name", "error")


def _runs(text: str) -> str:
    """A run whose text keeps its tabs and line ends."""
    parts = re.split(r"([\t\n])", text)
    return "".join({"\t": "<w:tab/>", "\n": "<w:br/>"}.get(x) or f'<w:t xml:space="preserve">{escape(x)}</w:t>' for x in parts if x)


def _document_xml(texts) -> str:
    ps = "".join(f"<w:p><w:r>{_runs(t)}</w:r></w:p>" for t in texts)
    return ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            f'<w:document xmlns:w="{W}"><w:body>{ps}</w:body></w:document>')


def _address(spark: SparkSession, folder: str) -> str:
    """The folder with the file system that Spark would use for it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    whole = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return re.sub(r"^file:/+", "file:///", whole)


def write_folder(paragraphs: DataFrame, folder: str) -> int:
    """Write paragraphs(protocol_name, para_idx, text) as one ``.docx`` per
    protocol name into ``folder`` (a shared path); returns files written."""
    address = _address(paragraphs.sparkSession, folder)

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        from pyarrow.fs import FileSystem

        fs, path = FileSystem.from_uri(address)  # an address it doesn't know is an error
        fs.create_dir(path, recursive=True)
        pdf = pdf.sort_values("para_idx")
        name = pdf["protocol_name"].iloc[0]
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("[Content_Types].xml", _CT)
            z.writestr("_rels/.rels", _RELS)
            z.writestr("word/document.xml", _document_xml(pdf["text"].tolist()))
        tmp = f"{path}/_{uuid.uuid4().hex}-{name}.tmp"
        with fs.open_output_stream(tmp) as f:
            f.write(buf.getvalue())
        fs.move(tmp, f"{path}/{name}")
        return pd.DataFrame({"n": [1]})

    done = paragraphs.groupBy("protocol_name").applyInPandas(write, "n long")
    return done.agg(F.sum("n")).first()[0] or 0
