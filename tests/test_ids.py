"""Paragraph ids stay distinct and in order for turns of many lines."""

import pyarrow as pa
import pyarrow.parquet as pq

from corpuslab.sources.transcripts import raw_paragraphs


def test_paragraphs_of_long_turns_keep_their_order(spark, tmp_path):
    long = "\n".join(f"line {i}" for i in range(12_000))
    table = pa.table({"conv_id": pa.array([1, 1, 1], pa.int64()), "turn": pa.array([0, 1, 2], pa.int32()),
                      "role": ["user"] * 3, "text": [long, "after", "last"]})
    pq.write_table(table, tmp_path / "conversations.parquet")
    rows = raw_paragraphs(spark, str(tmp_path)).orderBy("para_idx").collect()
    assert len({r.para_idx for r in rows}) == len(rows) == 12_001 + 2 + 2
    assert [r.text for r in rows[-4:]] == ["<< user >>:", "after", "<< user >>:", "last"]
    assert [r.text for r in rows[1:12_001]] == long.split("\n")
