import os

import pytest

from foldline.sources.files import (
    SourceName,
    source_format,
    read_headerless_csv,
    read_source,
    require_nonempty,
)
from tests.conftest import write_text


def test_format_dispatch():
    assert source_format("hdfs://nn/x/samples.csv") == "csv"
    assert source_format("https://host/a/Data.JSON") == "json"
    assert source_format("file:/x/samples.CSV") == "csv"
    assert source_format("/x/samples.csv", "JSON") == "json"
    assert source_format("/x/whatever", ".csv") == "csv"
    assert SourceName.of("https://h/p/my%5Ffile.csv") == SourceName("my_file.csv", "csv")
    for bad in ["/x/samples.txt", "/x/.hidden.csv", "/x/dir/"]:
        with pytest.raises(ValueError):
            source_format(bad)
    with pytest.raises(ValueError):
        source_format("/x/a.csv", "parquet")


def test_csv_defaults_header_and_inference(spark, tmp_dir):
    path = write_text(os.path.join(tmp_dir, "samples.csv"), "a,b,c\n1,2.5,x\n3,4.5,y\n")
    df = read_source(spark, path)
    assert df.columns == ["a", "b", "c"]
    assert dict(df.dtypes) == {"a": "int", "b": "double", "c": "string"}
    # caller's options win
    raw = read_source(spark, path, read_options={"header": False})
    assert raw.count() == 3


def test_csv_duplicate_headers_and_ragged_rows(spark, tmp_dir):
    path = write_text(os.path.join(tmp_dir, "dup.csv"), "h1,h2,H1\n1,2,3\n")
    assert read_source(spark, path).columns == ["h10", "h2", "H12"]
    ragged = write_text(os.path.join(tmp_dir, "ragged.csv"), "a,b,c\n1,2\n1,2,3,4\n")
    rows = read_source(spark, ragged, schema="a int, b int, c int").collect()
    assert sorted((tuple(r) for r in rows), key=repr) == [(1, 2, 3), (1, 2, None)]


def test_json_lines_and_corrupt_records(spark, tmp_dir):
    path = write_text(
        os.path.join(tmp_dir, "bad.json"),
        '{"a": 1}\n[1, 2]\n{"a": 2}\nnot json\n5\n',
    )
    df = read_source(spark, path)
    assert "_corrupt_record" in df.columns
    assert df.cache().where("_corrupt_record IS NOT NULL").count() == 3


def test_headerless_csv(spark, tmp_dir):
    path = write_text(os.path.join(tmp_dir, "samples.csv"), "5.1,3.5,1.4,0.2,kind-a\n4.9,3.0,1.4,0.2,kind-a\n")
    names = ["sepal_length", "sepal_width", "petal_length", "petal_width", "species"]
    df = read_headerless_csv(spark, path, names)
    assert df.columns == names
    assert [t for _, t in df.dtypes] == ["double"] * 4 + ["string"]
    typed = read_headerless_csv(spark, path, names, ["double"] * 4 + ["string"])
    assert typed.count() == 2
    with pytest.raises(ValueError):
        read_headerless_csv(spark, path, names[:3])
    with pytest.raises(ValueError):
        read_headerless_csv(spark, path, ["a", " ", "c", "d", "e"])
    with pytest.raises(ValueError):
        read_headerless_csv(spark, path, ["a", "A", "c", "d", "e"])


def test_empty_source_guard(spark, tmp_dir):
    empty = write_text(os.path.join(tmp_dir, "empty.csv"), "")
    with pytest.raises(ValueError):
        require_nonempty(spark, empty)
    header_only = write_text(os.path.join(tmp_dir, "h.csv"), "a,b\n")
    require_nonempty(spark, header_only)


def test_multiline_json_and_csv(spark, tmp_dir):
    doc = write_text(os.path.join(tmp_dir, "doc.json"), '[{"a": 1,\n  "b": "x"},\n {"a": 2, "b": "y"}]\n')
    df = read_source(spark, doc, read_options={"multiLine": True})
    assert sorted(tuple(r) for r in df.select("a", "b").collect()) == [(1, "x"), (2, "y")]
    text = write_text(os.path.join(tmp_dir, "t.csv"), 'id,text\n1,"line one\nline two"\n2,plain\n')
    rows = read_source(spark, text, read_options={"multiLine": True, "escape": '"'}).collect()
    assert [r.text for r in sorted(rows, key=lambda r: r.id)] == ["line one\nline two", "plain"]


def test_documents_with_line_breaks_round_trip(spark, tmp_dir):
    from foldline.operators.consolidate import consolidate
    from foldline.sinks.files import publish_file
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang")
    path = publish_file(docs, "documents.csv", tmp_dir)
    back = read_source(spark, path, read_options={"multiLine": True, "escape": '"'}, schema=docs.schema)
    a, b = consolidate(docs), consolidate(back)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
