"""Types proposed from the cells of CSV files."""

from __future__ import annotations

import pytest

from evenkeel.__main__ import main
from evenkeel.sources import evidence, tables
from evenkeel.spec import FeatureSpec


def write(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def report(spark, path, **options):
    return {r["column"]: r.asDict() for r in evidence.csv_evidence(spark, path, **options).collect()}


@pytest.mark.parametrize(
    ("cells", "kind"),
    [
        (["1", "-7", "+3"], "int"),
        (["1", "2147483648"], "bigint"),
        (["1", "9223372036854775808"], "double"),
        (["1", ".5", "2.", "1e-3"], "double"),
        (["1.0d"], "string"),
        (["0x1F"], "string"),
        (["True", "false"], "boolean"),
        (["true", "1"], "string"),
        (["2020-02-29"], "date"),
        (["2020-02-30"], "string"),
        (["2020-02-29", "2020-02-29 10:00:00"], "timestamp_ntz"),
        (["2020-02-29", "5"], "string"),
        (["1", " 2"], "string"),
        (["NaN"], "string"),
        ([None, None], "string"),
        (["١"], "string"),
        ([], "string"),
    ],
)
def test_type_holds_every_cell(spark, cells, kind):
    frame = spark.createDataFrame([(c,) for c in cells], "`a.b` string")
    found = evidence.column_evidence(frame).collect()
    assert [(r["column"], r["type"]) for r in found] == [("a.b", kind)]
    assert found[0]["values"] == sum(c is not None for c in cells)


def test_conflicts_between_files_are_named(spark, tmp_path):
    path = write(
        tmp_path / "t",
        a="id,kind,zip,gap\n1,10,00501,\n2,11,10001,\n3,12,10002,\n",
        b='id,kind,zip,gap\n4,"x,y",10003,\n5,unknown,10004,\n6,13,10005,\n',
        c='id,kind,zip,gap\n7,"",10006,\n8,15,10007,\n',
    )
    found = report(spark, path)
    assert list(found) == ["id", "kind", "zip", "gap"]
    assert (found["id"]["type"], found["id"]["mostly"], found["id"]["misfits"]) == ("int", None, None)
    kind = found["kind"]
    assert (kind["type"], kind["mostly"], kind["values"], kind["misfits"], kind["misfit_files"]) == (
        "string", "int", 8, 3, 2,
    )
    assert kind["example"] == "" and kind["example_file"].endswith("c.csv")
    assert (found["zip"]["type"], found["zip"]["padded"], found["zip"]["longest"]) == ("int", 1, 5)
    assert (found["gap"]["type"], found["gap"]["values"], found["gap"]["nulls"]) == ("string", 0, 8)
    assert report(spark, path, majority=0.9)["kind"]["mostly"] is None
    back = tables.read_csv(spark, path, evidence.proposed_types(evidence.csv_evidence(spark, path)))
    assert dict(back.dtypes) == {"id": "int", "kind": "string", "zip": "int", "gap": "string"}
    assert back.count() == 8


def test_header_only(spark, tmp_path):
    found = report(spark, write(tmp_path / "t", a="id,kind\n"))
    assert {c: (r["type"], r["values"], r["nulls"]) for c, r in found.items()} == {
        "id": ("string", 0, 0), "kind": ("string", 0, 0),
    }


def test_other_headers_fail(spark, tmp_path):
    path = write(tmp_path / "t", a="id,kind\n1,2\n", b="kind,id\n1,2\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        report(spark, path)


def test_one_pass_unless_there_is_a_conflict(spark, tmp_path, monkeypatch):
    path = write(tmp_path / "t", a="id,kind\n1,2\n")
    passes = []
    real = evidence.kind_of
    monkeypatch.setattr(evidence, "kind_of", lambda cell: passes.append(cell) or real(cell))
    report(spark, path)
    assert len(passes) == 1


def test_command_tells_what_a_spec_cannot_read(spark, tmp_path):
    path = write(tmp_path / "t", a="id,y,amount,kind,more\n1,0,2,7,9\n2,1,n/a,8,9\n3,1,2.5,9,9\n")
    spec = tmp_path / "spec.json"
    spec.write_text(FeatureSpec("id", "y", amounts=("amount", "absent"), categories=("kind",)).to_json())
    out = str(tmp_path / "report")
    main(["propose-types", "--table", path, "--report", out, "--spec", str(spec)])
    rows = {r["column"]: r for r in spark.read.csv(out, header=True).collect()}
    assert {c: (r["type"], r["declared"], r["fits"]) for c, r in rows.items()} == {
        "id": ("int", "bigint", "true"), "y": ("int", "int", "true"), "amount": ("string", "double", "false"),
        "kind": ("int", "string", "true"), "more": ("int", None, "true"), "absent": (None, "double", "false"),
    }
    assert (rows["amount"]["mostly"], rows["amount"]["example"]) == ("double", "n/a")
    plain = str(tmp_path / "plain")
    main(["propose-types", "--table", path, "--report", plain])
    assert [r["column"] for r in spark.read.csv(plain, header=True).collect()] == ["id", "y", "amount", "kind", "more"]
