import os

import pytest

from foldline.operators.consolidate import consolidate
from foldline.plans import flow, print_rows, transform
from foldline.sinks.files import publish_file
from foldline.sources.catalog import read_table
from foldline.sources.files import read_source

SF = "/root/testdata/sf0.001"


def test_transform_reads_filters_and_folds(spark, tmp_dir):
    customer = spark.read.parquet(f"{SF}/customer.parquet").select("c_nationkey", "c_mktsegment")
    src = publish_file(customer, "customer.csv", tmp_dir)
    inferred = transform(spark, src, column_names=["nation", "segment"],
                         filter_column="segment", filter_value="BUILDING")
    assert inferred.columns == ["nation", "segment", "occurrences"]
    expect = consolidate(customer.where("c_mktsegment = 'BUILDING'")).toDF(*inferred.columns)
    assert inferred.exceptAll(expect).count() == 0 and expect.exceptAll(inferred).count() == 0


def test_flow_table_then_file(spark, tmp_dir, capsys):
    rows = "sepal_length,sepal_width,petal_length,petal_width,species\n"
    rows += "5.1,3.5,1.4,0.2,kind-a\n5.1,3.5,1.4,0.2,kind-a\n7.0,3.2,4.7,1.4,kind-b\n"
    src = os.path.join(tmp_dir, "samples.csv")
    with open(src, "w") as handle:
        handle.write(rows)
    result = flow(
        spark, src, "https://example.org/samples.csv", os.path.join(tmp_dir, "out"), "sample_db", "samples",
        warehouse_dir=os.path.join(tmp_dir, "wh"), filter_column="species", filter_value="kind-a",
        preview_rows=5,
    )
    assert result.rows == 1
    stored = read_table(spark, "sample_db", "samples").collect()
    assert [r.occurrences for r in stored] == [2]
    published = read_source(spark, result.file_path).collect()
    assert [tuple(r) for r in published] == [tuple(r) for r in stored]
    assert "Data (1 rows):" in capsys.readouterr().out


def test_print_rows_requires_a_limit(spark, capsys):
    df = spark.range(30)
    assert print_rows(df, 3) == 30
    out = capsys.readouterr().out
    assert "only showing top 3 rows" in out


def test_land_headerless_csv_with_names(spark, tmp_dir):
    from foldline.plans import land_source
    src = os.path.join(tmp_dir, "src", "samples.csv")
    os.makedirs(os.path.dirname(src))
    with open(src, "w") as handle:
        handle.write("5.1,3.5,kind-a\n4.9,3.0,kind-a\n")
    landed = land_source(spark, src, os.path.join(tmp_dir, "in"), ["sl", "sw", "species"])
    assert landed.endswith("/in/samples.csv")
    back = read_source(spark, landed)
    assert back.columns == ["sl", "sw", "species"] and back.count() == 2
    assert dict(back.dtypes)["sl"] == "double"
    # landing again replaces the old copy
    with open(src, "w") as handle:
        handle.write("1.0,2.0,x\n")
    land_source(spark, src, os.path.join(tmp_dir, "in"), ["sl", "sw", "species"])
    assert read_source(spark, landed).count() == 1


def test_land_json_and_guards(spark, tmp_dir, capsys):
    from foldline.plans import land_source, print_file
    src = os.path.join(tmp_dir, "e.json")
    with open(src, "w") as handle:
        handle.write('{"a": 1, "b": [1, 2]}\n{"a": 2, "b": null}\n')
    landed = land_source(spark, src, os.path.join(tmp_dir, "in"))
    assert read_source(spark, landed).count() == 2
    assert print_file(spark, landed, 5) == 2
    assert "[1,2]" in capsys.readouterr().out
    import pytest
    with pytest.raises(ValueError):
        land_source(spark, src, os.path.join(tmp_dir, "in"), ["x"])
    empty = os.path.join(tmp_dir, "empty.csv")
    open(empty, "w").close()
    with pytest.raises(ValueError):
        land_source(spark, empty, os.path.join(tmp_dir, "in"))


def test_landing_keeps_every_value(spark, tmp_dir):
    from foldline.plans import land_source
    src = os.path.join(tmp_dir, "v.csv")
    with open(src, "w", newline="") as handle:
        handle.write('x;x;c\n 1 ;"a;b";"two\nlines"\n2;"say ""hi""";\n')
    options = {"sep": ";", "escape": '"', "multiLine": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    landed = land_source(spark, src, os.path.join(tmp_dir, "in"), read_options=options)
    read = lambda p: sorted(map(tuple, read_source(spark, p, read_options=options, schema="x string, y string, c string").collect()))
    assert read(landed) == read(src) == [(" 1 ", "a;b", "two\nlines"), ("2", 'say "hi"', None)]
    ragged = os.path.join(tmp_dir, "r.csv")
    with open(ragged, "w") as handle:
        handle.write("a,b\n1,2,3\n")
    with pytest.raises(Exception):
        land_source(spark, ragged, os.path.join(tmp_dir, "in"))
    assert not os.path.exists(os.path.join(tmp_dir, "in", "r.csv"))


def test_landing_json_lines_and_documents(spark, tmp_dir):
    from foldline.plans import land_source
    lines, whole = os.path.join(tmp_dir, "l.json"), os.path.join(tmp_dir, "w.json")
    with open(lines, "w", newline="") as handle:
        handle.write('{"a": " x\\n "}\r\n{"a": "y"}\n')
    with open(whole, "w") as handle:
        handle.write('[{"a": 1,\n "b": 2},\n {"a": 3}]')
    landed = land_source(spark, lines, os.path.join(tmp_dir, "in"))
    assert [r.a for r in read_source(spark, landed).collect()] == [" x\n ", "y"]
    multi = land_source(spark, whole, os.path.join(tmp_dir, "in"), read_options={"multiLine": True})
    assert sorted(map(tuple, read_source(spark, multi, read_options={"multiLine": True}).collect())) == [(1, 2), (3, None)]


def test_flow_without_a_table(spark, tmp_dir, capsys):
    src = os.path.join(tmp_dir, "s.csv")
    with open(src, "w") as handle:
        handle.write("a,b\n1,x\n1,x\n")
    result = flow(spark, src, "s.csv", os.path.join(tmp_dir, "out"), preview_rows=5)
    assert result.table_location is None and result.rows == 1
    assert [tuple(r) for r in read_source(spark, result.file_path).collect()] == [(1, "x", 2)]
    with pytest.raises(ValueError):
        flow(spark, src, "s.csv", os.path.join(tmp_dir, "out"), "db_only")


def _flow_in(spark, place, rows, **options):
    src = os.path.join(place, "items.csv")
    with open(src, "w") as handle:
        handle.write("kind,size\n" + "".join(f"{k},{s}\n" for k, s in rows))
    database = "flow_" + os.path.basename(place).replace("-", "_")
    return flow(spark, src, "items.csv", os.path.join(place, "out"), database, "items",
                warehouse_dir=os.path.join(place, "wh"), schema="kind string, size int", preview_rows=None, **options), database


def _both(spark, place, database):
    path = os.path.join(place, "out", "transformed_items.csv")
    schema = "kind string, size int, occurrences long"
    return (sorted(map(tuple, read_table(spark, database, "items").collect())),
            sorted(map(tuple, read_source(spark, path, schema=schema).collect())))


@pytest.mark.parametrize("single", [False, True])
@pytest.mark.parametrize("dies_in", ["_write_intent", "commit_table", "publish_staged"])
def test_a_flow_that_dies_leaves_both_old_or_both_new(spark, tmp_dir, monkeypatch, dies_in, single):
    from foldline.plans import flow as flow_function  # noqa: F401
    import sys

    module = sys.modules["foldline.plans.flow"]
    _, database = _flow_in(spark, tmp_dir, [("a", 1), ("a", 1)], single_file=single)
    old, new = [("a", 1, 2)], [("b", 5, 1), ("b", 6, 1)]
    assert _both(spark, tmp_dir, database) == (old, old)
    real = getattr(module, dies_in)

    def dies(*arguments, **named):
        raise KeyboardInterrupt

    monkeypatch.setattr(module, dies_in, dies)
    with pytest.raises(KeyboardInterrupt):
        _flow_in(spark, tmp_dir, [("b", 5), ("b", 6)], single_file=single)
    monkeypatch.setattr(module, dies_in, real)
    out = os.path.join(tmp_dir, "out")
    finished = module.finish_flows(spark, out)
    assert (finished, _both(spark, tmp_dir, database)) == ((0, (old, old)) if dies_in == "_write_intent" else (1, (new, new)))
    assert module.finish_flows(spark, out) == 0
    _flow_in(spark, tmp_dir, [("c", 9)], single_file=single)
    assert _both(spark, tmp_dir, database) == ([("c", 9, 1)], [("c", 9, 1)])
    assert not [n for n in os.listdir(out) if "intent" in n or "_old" in n]


def test_publishing_again_changes_nothing(spark, tmp_dir, monkeypatch):
    """A flow that dies after both were published, before its record went, is not undone by later writes."""
    import sys

    module = sys.modules["foldline.plans.flow"]
    records, real = [], module._write_intent
    monkeypatch.setattr(module, "_write_intent", lambda spark, out, what: records.append(what) or real(spark, out, what))
    _, database = _flow_in(spark, tmp_dir, [("a", 1)])
    _flow_in(spark, tmp_dir, [("b", 2)])
    for what in records[::-1]:
        real(spark, os.path.join(tmp_dir, "out"), what)
    assert module.finish_flows(spark, os.path.join(tmp_dir, "out")) == 2
    assert _both(spark, tmp_dir, database) == ([("b", 2, 1)], [("b", 2, 1)])
