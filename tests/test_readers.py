import csv
import gzip
import io
import json
import random
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from entityfold.operators import GateError
from entityfold.plans import normalise
from entityfold.sources import (
    decode_workbooks,
    delimited,
    first_bad_record,
    gate_quotes,
    gate_rectangular,
    locate_header,
    numbered_records,
    pick_snapshot,
    read_delimited,
    read_grant_awards,
    read_listing,
    read_ocds,
    read_register_xml,
    read_workbook_grid,
    register_rows,
)
from entityfold.sources.snapshots import income_year_in, year_in
from entityfold.sources.workbook import has_any
from queries.workbooks import encode_workbook
from tests import landing


def write(tmp_path, text, name="f.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode("utf-8") if isinstance(text, str) else text)
    return str(path)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- delimited ---


def test_quoted(spark, tmp_path):
    text = 'a,b\n1,"x, ""y"""\n2,"line1\nline2"\n3,\n'
    df = read_delimited(spark, write(tmp_path, text), ",", quoting=True)
    assert tuples(df) == [("1", 'x, "y"'), ("2", "line1\nline2"), ("3", None)]


def test_literal(spark, tmp_path):
    text = '\ufeffA B\tC\r\n"1\tC:\\P\r\n\\N\t""\r\n'
    df = read_delimited(spark, write(tmp_path, text), "\t", quoting=False)
    assert df.columns == ["a_b", "c"]
    assert tuples(df) == [('"1', "C:\\P"), ("\\N", '""')]


def test_files_are_read_together(spark, tmp_path):
    write(tmp_path, "a,b\n1,2\n", "one.csv")
    write(tmp_path, "a,b\n3,4\n", "two.csv")
    assert tuples(read_delimited(spark, str(tmp_path), ",", quoting=True)) == [
        ("1", "2"),
        ("3", "4"),
    ]
    write(tmp_path, "b,a\n5,6\n", "three.csv")
    with pytest.raises(GateError, match="differ in their header"):
        read_delimited(spark, str(tmp_path), ",", quoting=True)


@pytest.mark.parametrize("row", ["1", "1,2,3", '1,"2\n3",4'])
def test_ragged_rows(spark, tmp_path, row):
    path = write(tmp_path, f"a,b\n1,2\n{row}\n3,4\n")
    with pytest.raises(GateError, match="width differs"):
        gate_rectangular(spark, path, ",", quoting=True)
    for use in (lambda df: df.count(), lambda df: df.select("a").collect(), lambda df: df.select("b").collect()):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            use(read_delimited(spark, path, ",", quoting=True))


def test_ragged_literal_row(spark, tmp_path):
    path = write(tmp_path, 'a\tb\n1\t2\n"1\t2"\t3\n')
    with pytest.raises(GateError, match="width differs"):
        gate_rectangular(spark, path, "\t", quoting=False)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_delimited(spark, path, "\t", quoting=False).count()


def test_blank_line(spark, tmp_path):
    with pytest.raises(GateError, match="blank line"):
        read_delimited(spark, write(tmp_path, "a,b\n\n1,2\n"), ",", quoting=True)


def test_blank_line_among_records_with_line_breaks(spark, tmp_path):
    whole = write(tmp_path, 'a,b\n1,"x\ny"\n3,"\n\n"\n', "whole.csv")
    assert len(tuples(read_delimited(spark, whole, ",", quoting=True))) == 2
    for text in ('a,b\n1,"x\ny"\n\n3,4\n', 'a,b\n1,"x\ny"\n3,4\n\n', 'a,b\n\n1,"x\ny"\n'):
        with pytest.raises(GateError, match="blank line"):
            read_delimited(spark, write(tmp_path, text), ",", quoting=True)
        with pytest.raises(GateError, match="blank line"):
            gate_rectangular(spark, write(tmp_path, text), ",", quoting=True)


def test_unterminated_quote(spark, tmp_path):
    path = write(tmp_path, 'a,b\n1,"open\n2,3\n')
    with pytest.raises(GateError, match="unterminated"):
        gate_quotes(spark, path)
    with pytest.raises(GateError, match="unterminated"):
        read_delimited(spark, path, ",", quoting=True)
    literal = write(tmp_path, 'a\tb\n1\t"open\n', "l.tsv")
    assert tuples(read_delimited(spark, literal, "\t", quoting=False)) == [("1", '"open')]


def awkward_files(tmp_path):
    """Two files with line breaks, quotes and long runs of lines inside quotes; their rows."""
    pick = random.Random(1)
    parts = ["a", "b c", '"', "\n", "\r\n", ",", "é", "\r", "\n\n", "x" * 50]

    def value():
        return "".join(pick.choices(parts, weights=[9, 5, 2, 2, 1, 2, 1, 0.3, 0.3, 1], k=pick.randrange(9)))

    one = [(str(i), value(), value()) for i in range(600)]
    run = [pick.randrange(3000) if i % 50 == 0 else 0 for i in range(300)]
    two = [(str(600 + i), value().replace("\r", ""), "z" + "\n" * n) for i, n in enumerate(run)]
    for name, rows, end in (("a.csv", one, "\r\n"), ("b.csv", two, "\n")):
        held = io.StringIO()
        writer = csv.writer(held, lineterminator=end, quoting=csv.QUOTE_ALL)
        writer.writerows([("k", "a", "b"), *rows])
        write(tmp_path, held.getvalue(), name)
    return [(k, a or None, b or None) for k, a, b in one + two]


@pytest.mark.parametrize(("size", "most_blocks"), [(None, 200_000), ("2000", 200_000), ("700", 200_000), ("2000", 0)])
def test_records_over_several_lines_are_read_in_splits(spark, tmp_path, monkeypatch, size, most_blocks):
    monkeypatch.setattr(delimited, "MOST_BLOCKS", most_blocks)  # 0: blocks are met by a shuffle
    want = awkward_files(tmp_path)
    if size:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_delimited(spark, str(tmp_path), ",", quoting=True)
        assert tuples(df) == sorted(want, key=repr)
        if size and most_blocks:
            assert df.rdd.getNumPartitions() > 15
        found = numbered_records(spark, str(tmp_path / "b.csv"), quoting=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    lines = (tmp_path / "b.csv").read_bytes().decode().split("\n")
    assert len(found) == 300
    for r in found:  # each text stands on the line that it is said to begin on
        assert r["text"] == "\n".join(lines[r["line"] - 1 : r["line"] + r["text"].count("\n")])


@pytest.mark.parametrize(
    ("text", "sep", "line"),
    [
        ('a,b\n1,"x\n\ny"\n2,3,4\n5,6\n', ",", 5),
        ('a,b\r\n1,"x\r\ny"\r\n2,"3\r\n"\r\n5\r\n', ",", 6),
        ("a,b\n1,2\n3\n4\n", ",", 3),
        ('a\tb\n"1\t2\n3\t4\t5\n', "\t", 3),
        ('a,b\n1,"x\ny"\n\n2,3\n', ",", 4),
    ],
)
def test_the_line_of_a_bad_record(spark, tmp_path, text, sep, line):
    path, quoting = write(tmp_path, text), sep == ","
    assert first_bad_record(spark, path, sep, quoting).endswith(f"f.csv at line {line}")
    with pytest.raises(GateError, match=f"'line': {line},"):
        gate_rectangular(spark, path, sep, quoting)
    if "\ny" in text and "\n\n2" not in text:  # records over several lines tell it themselves
        with pytest.raises(Exception, match=f"f.csv at line {line}"):
            read_delimited(spark, path, sep, quoting).select("a").collect()


def test_no_bad_record(spark, tmp_path):
    assert first_bad_record(spark, write(tmp_path, 'a,b\n1,"x\ny"\n'), ",", True) is None


def test_where_an_open_quote_begins(spark, tmp_path):
    path = write(tmp_path, 'a,b\n1,"x\ny"\n2,"open\n3,4\n')
    with pytest.raises(GateError, match="starting at line 4"):
        read_delimited(spark, path, ",", quoting=True)
    with pytest.raises(GateError, match="'line': 4"):
        gate_quotes(spark, path)


def test_carriage_returns_alone(spark, tmp_path):
    kept = write(tmp_path, 'a,b\n1,"x\ry"\n', "kept.csv")
    assert tuples(read_delimited(spark, kept, ",", quoting=True)) == [("1", "x\ry")]
    with pytest.raises(GateError, match="line break"):
        read_delimited(spark, write(tmp_path, "a,b\r1,2\r", "old.csv"), ",", quoting=True)


def test_one_column_over_several_lines(spark, tmp_path):
    path = write(tmp_path, 'a\n"x\n\ny"\n\nz\n')
    assert tuples(read_delimited(spark, path, ",", quoting=True)) == [("x\n\ny",), ("z",)]


def test_headers(spark, tmp_path):
    with pytest.raises(GateError, match="collapse"):
        read_delimited(spark, write(tmp_path, "Sub Class,Sub-Class\n1,2\n"), ",", quoting=True)
    with pytest.raises(GateError, match="2 columns in the file, 3"):
        read_delimited(spark, write(tmp_path, "a,b\n1,2\n"), ",", True, expected_cols="abc")
    with pytest.raises(GateError, match="no header"):
        read_delimited(spark, write(tmp_path, "\n"), ",", quoting=True)


# --- register XML ---


def keys(spark, tmp_path, body):
    path = tmp_path / "t.xml"
    path.write_text(f"<?xml version='1.0'?><Transfer><Info/>{body}</Transfer>")
    return sorted(r["abn"] for r in register_rows(read_register_xml(spark, str(path))).collect())


def record(n, end="</ABR>", start="<ABR>"):
    return f"{start}<ABN>{n}</ABN>{end}"


@pytest.mark.parametrize(
    ("body", "found"),
    [
        (record(1, "</ABR >") + record(2) + record(3), ["1", "2", "3"]),
        (record(1) + record(2, "</ABR\n>") + record(3, "</ABR >"), ["1", "2", "3"]),
        ("<ABR a='x>/>'/>" + record(1), ["", "1"]),
        (record(1) + "<ABR/>", ["", "1"]),
        ("<ABR/><ABR />" + record(1, "</ABR >") + record(2), ["", "", "1", "2"]),
        ("<!-- <ABR> -->" + record(1) + "<!-- a <ABR x --><!-- -->" + record(2), ["1", "2"]),
        (record(1, start="<ABR\nx='1'>") + "<ABRX/>" + record(2), ["1", "2"]),
        ("", []),
    ],
)
def test_every_record_start_gives_a_row(spark, tmp_path, body, found):
    assert keys(spark, tmp_path, body) == found


@pytest.mark.parametrize(
    "body",
    [
        "<ABR><ABN>1</ABN>" + record(2),
        record(1) + "<ABR><ABN>2</ABN>",
        record(1) + "<!-- </ABR> -->" + record(2),
        "<ABR><ABN>1</ABN><ABR/></ABR>" + record(2),
    ],
)
def test_records_that_are_not_whole_are_an_error(spark, tmp_path, body):
    with pytest.raises(Exception, match="MALFORMED|alformed|not one whole"):
        keys(spark, tmp_path, body)


def test_register_rows(spark, tmp_path):
    rows = {
        r["abn"]: r
        for r in register_rows(
            read_register_xml(spark, landing.register_files(tmp_path))
        ).collect()
    }
    assert len(rows) == 8
    firm, trust, bare = rows[landing.FIRM], rows[landing.TRUST], rows[landing.BARE]
    assert firm["business_names"] == ["Quill & Sons"] and firm["asic_number_type"] == "acn"
    assert trust["address_state"] == "" and trust["address_postcode"] is None
    assert [g["status"] for g in trust["dgr"]] == [None, "ACT"]
    assert bare["abn_status_from_date"] is None and bare["dgr"] == []
    assert bare["entity_type_code"] is None and bare["business_names"] == []


def test_many_splits_give_the_same_rows(spark, tmp_path):
    records = [landing.record(landing.abn(n), landing.PRIVATE) for n in range(400)]
    path = write(tmp_path, landing.document(*records), "r.xml")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        df = read_register_xml(spark, path)
        assert df.rdd.getNumPartitions() > 10
        assert register_rows(df).select("abn").distinct().count() == 400
        assert df.count() == 400
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize(
    "damage",
    [
        lambda t: t[: t.rindex("</ABR>")],  # cut off just before the end of a record
        lambda t: t[: t.rindex("</ABR>") + 6],  # cut off between records
        lambda t: t[: t.index("<EntityTypeText>") + 20],
        lambda t: t + t,
    ],
)
def test_damaged_files(spark, tmp_path, damage):
    text = landing.document(landing.record(landing.FIRM, landing.PRIVATE))
    with pytest.raises(GateError, match="not one whole XML document"):
        read_register_xml(spark, write(tmp_path, damage(text), "r.xml"))


def test_malformed_record(spark, tmp_path):
    text = landing.document(landing.record(landing.FIRM, "<EntityType><Oops></EntityType>"))
    df = read_register_xml(spark, write(tmp_path, text, "r.xml"))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        df.collect()


# --- contract releases ---


def releases_file(tmp_path, lines):
    text = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines)
    return write(tmp_path, gzip.compress(text.encode()), "r.jsonl.gz")


def test_spend(spark, tmp_path):
    rel = landing.release
    path = releases_file(
        tmp_path,
        [
            rel("a", ["40000000321"], "1000.00", "2020-01-01"),
            {"releases": [rel("b", ["40000000321"], 500.5, "2022-06-01"), rel(None, [], 1, None)]},
            "",
            rel("b", ["40000000321"], "9999.00", "2023-01-01"),
            rel("c", ["40000000654", "40000000321"], "0.005", None),
        ],
    )
    assert read_ocds(spark, path).count() == 5
    got = {r["abn"]: tuple(r)[1:] for r in normalise.gov_spend(read_ocds(spark, path)).collect()}
    assert {k: (str(v[0]), v[1], str(v[2]), str(v[3])) for k, v in got.items()} == {
        "40000000321": ("1500.51", 3, "2020-01-01", "2022-06-01"),
        "40000000654": ("0.01", 1, "None", "None"),
    }


@pytest.mark.parametrize(
    ("line", "match"),
    [("{not json", "MALFORMED_RECORD"), ({"hello": 1}, "neither a release nor a package")],
)
def test_foreign_lines(spark, tmp_path, line, match):
    path = releases_file(tmp_path, [landing.release("a", [], "1", None), line])
    with pytest.raises(Exception, match=match):
        read_ocds(spark, path).collect()


# --- workbooks ---


def test_cells(spark, tmp_path):
    """Shared and rich text, formula results, links, gaps, numbers with exponents."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    out = io.BytesIO(encode_workbook([("S", [])]))
    old = zipfile.ZipFile(out)
    new = io.BytesIO()
    with zipfile.ZipFile(new, "w") as book:
        for name in old.namelist():
            if not name.endswith("sheet1.xml"):
                book.writestr(name, old.read(name))
        book.writestr(
            "xl/sharedStrings.xml",
            f'<sst xmlns="{main}"><si><t>plain</t></si><si><r><t>ri</t></r><r><t>ch</t></r>'
            "<rPh><t>no</t></rPh></si></sst>",
        )
        book.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet xmlns="{main}"><sheetData><row r="3">'
            '<c r="A3" t="s"><v>0</v></c><c r="C3" t="s"><v>1</v></c>'
            '<c r="D3"><f>1+1</f><v>2</v></c><c r="E3" t="str"><f>"x"</f><v>x</v></c>'
            '<c r="AB3"><v>4.0000000654E10</v></c><c><v>0.5</v></c><c t="b"><v>1</v></c>'
            '<c t="inlineStr"><is><t>in</t></is></c></row></sheetData></worksheet>',
        )
    row = read_workbook_grid(spark, write(tmp_path, new.getvalue(), "b.xlsx")).first()
    assert (row["sheet_no"], row["sheet"], row["row_no"]) == (0, "S", 3)
    gap = [None] * 22
    assert row["cells"] == [
        "plain", None, "rich", "2", "x", *gap, "40000000654", "0.5", "true", "in",
    ]


def grid_of(spark, *sheets):
    content = bytearray(encode_workbook(list(sheets)))
    return decode_workbooks(
        spark.createDataFrame([("b.xlsx", content)], "path string, content binary")
    )


def test_workbooks_without_the_columns_they_need(spark):
    no_key = grid_of(spark, ("S", [["foo", "bar"], [1, 2]]))
    with pytest.raises(Exception, match="no header row in b.xlsx"):
        normalise.tax_transparency(no_key).collect()
    no_year = grid_of(spark, ("S", [["ABN", "Total income $"], [40000000654, 2]]))
    with pytest.raises(Exception, match="column not found"):
        normalise.tax_transparency(no_year).collect()
    amended = grid_of(
        spark, ("S", [["ABN/ACN", "Total amended R&D expenditure $", "Income Year"], [4080199, 1, "x"]])
    )
    with pytest.raises(Exception, match="column not found: total r&d expenditure"):
        normalise.rd_tax_incentive(amended).collect()
    late = grid_of(spark, ("S", [["x"]] * 10 + [["ABN"], [40000000654]]))
    with pytest.raises(Exception, match="no header row"):
        normalise.tax_transparency(late).collect()


def test_locate_header(spark):
    grid = grid_of(spark, ("A", [["prose"]]), ("B", [["title"], ["Name", " ABN/ACN "], ["x", 1]]))
    header = locate_header(grid, has_any(["abn", "abn/acn"]), 10).first()
    assert tuple(header) == ("b.xlsx", 1, 2, ["name", "abn/acn"])


def test_grant_reports(spark):
    header = ["Recipient ABN", "Value (AUD)", "Publish Date"]
    awards = read_grant_awards(
        grid_of(
            spark,
            ("S", [["title"], header, ["40 000 000 321", "$1,000.005", "3-Jun-2026"], ["x", 5, None]]),
            ("T", [["40000000321", 1, None]]),
        )
    )
    got = [(r["recipient"], r["cents"], str(r["published"])) for r in awards.collect()]
    assert sorted(got, key=repr) == [("40000000321", 100001, "2026-06-03"), (None, 500, "None")]
    with pytest.raises(Exception, match="no header row"):
        read_grant_awards(grid_of(spark, ("S", [["Agency", "GA ID"]]))).collect()


# --- snapshots ---


def test_pick_snapshot(rows):
    listing = rows(
        [
            ("w", "2022 list.csv", 5, 1),
            ("w", "2020 list.csv", 9, 2),
            ("w", "2022 list.CSV", 7, 3),
            ("w", "2023 list.zip", 1, 4),
            ("t", "2022-23 report", 1, 1),
            ("t", "2023-24 report", 1, 2),
        ],
        "source string, name string, size long, pos int",
    )
    csv = F.lower("name").endswith(".csv")
    size, pos = F.col("size").desc(), F.col("pos")
    year = year_in(F.col("name")).desc()
    assert pick_snapshot(listing, "source", csv, [size, pos]).first()["pos"] == 2
    assert pick_snapshot(listing, "source", csv, [year, size, pos]).first()["pos"] == 3
    income = income_year_in(F.col("name")).desc()
    latest = pick_snapshot(listing, "source", F.col("source") == "t", [income, pos])
    assert latest.first()["pos"] == 2


def test_listing(spark, tmp_path):
    write(tmp_path, "abc", "one.csv")
    write(tmp_path, "abcdef", "two.txt")
    got = [(r["name"], r["size"]) for r in read_listing(spark, str(tmp_path), "*.csv").collect()]
    assert got == [("one.csv", 3)]


def test_release_lines_are_made_in_one_pass(spark):
    from queries.readers import release_lines

    lines = release_lines(spark, "/root/testdata/sf0.001")
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Union" not in plan
    rows = [json.loads(r.value) for r in lines.collect()]
    packed = Counter(json.dumps(r["releases"][0], sort_keys=True) for r in rows if "releases" in r)
    alone = Counter(json.dumps(r, sort_keys=True) for r in rows if "releases" not in r)
    assert alone and alone == Counter({k: n for k, n in packed.items() if "ocid" in json.loads(k)})
    assert any("ocid" not in json.loads(k) for k in packed)
