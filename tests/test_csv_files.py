"""Reading registry files, byte for byte."""

from __future__ import annotations

import gzip
import random

import pytest
from pyspark.sql import functions as F

from cadastra.operators.cleaning import cast_types, clean, read_report
from cadastra.schema import CORRUPT, RAW_COLUMNS
from cadastra.sources import csv_files, csv_lines

HEADER = ",".join(RAW_COLUMNS)
BOM = "\ufeff"
# The ways of reading: whole files, files in splits where they allow it, small files.
LAYOUTS = ["multiline", "auto", "auto small"]

# Six data lines, five rows: quotes with a line break, an empty year, a short row,
# a long row, a blank line, a latitude that is no number.
EDGE_BODY = (
    '1,55.1,32.7,1953.0,585.60,18,"Смоленская область","Ярцево",'
    '"ул. ""Новая"", д. 1\r\nкорп. 2","Дом, жилой"\r\n'
    "2,55.1,32.7,,585.60,18,R,C,A,D\r\n"
    "3,55.1,32.7,1960.0\r\n"
    "4,55.1,32.7,1960.0,10,2,R,C,A,D,extra\r\n"
    "\r\n"
    "5,north,32.7,1960.0,10,2,R,C,A,D\r\n"
)


@pytest.fixture
def folder(tmp_path):
    def write(**files: bytes) -> str:
        for name, content in files.items():
            (tmp_path / f"{name}.csv").write_bytes(content)
        return str(tmp_path)

    return write


@pytest.fixture
def tiny_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "700")
    yield
    spark.conf.set(key, before)


def read(spark, path, layout="multiline", **options):
    layout, _, small = layout.partition(" ")
    return csv_files.read_raw(spark, path, layout=layout, split_above=2**50 if small else 0, **options)


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("mark", ["", BOM])
def test_edge_file(spark, folder, layout, mark):
    path = folder(a=f"{mark}{HEADER}\r\n{EDGE_BODY}".encode("utf-16-le"))
    raw = read(spark, path, layout)
    assert raw.columns == [*RAW_COLUMNS, CORRUPT]
    rows = {r.house_id: r for r in raw.collect()}
    assert sorted(rows) == ["1", "2", "3", "4", "5"]
    assert rows["1"].address.replace("\r\n", "\n") == 'ул. "Новая", д. 1\nкорп. 2'
    assert rows["1"].description == "Дом, жилой"
    assert rows["2"].maintenance_year is None
    assert rows["3"].square is None
    assert rows["4"].description == "D"
    assert {i for i, r in rows.items() if r[CORRUPT] is not None} == {"3", "4"}
    assert read_report(raw).first().asDict() == {
        "total_rows": 5,
        "corrupt_rows": 2,
        "empty_rows": 0,
    }
    kept = {r.id: r for r in clean(raw).collect()}
    assert sorted(kept) == [1, 4, 5]
    assert kept[5].latitude is None and kept[5].longitude == 32.7


def test_headerless_sample_form(spark, folder):
    body = '590707,55.060199,32.695577,1953.0,585.60,18,"Область","Город","ул. А, д. 61","Дом «А»."\n'
    path = folder(a=body.encode())
    row = clean(read(spark, path, "auto", header=False, encoding="UTF-8")).first()
    assert row.asDict() == {
        "id": 590707,
        "latitude": 55.060199,
        "longitude": 32.695577,
        "year": 1953,
        "area": 585.6,
        "floors": 18,
        "region": "Область",
        "city": "Город",
        "address": "ул. А, д. 61",
        "description": "Дом «А».",
    }


@pytest.mark.parametrize("layout", LAYOUTS)
def test_columns_are_bound_by_header(spark, folder, layout):
    names = [*reversed(RAW_COLUMNS), "note"]
    path = folder(a=f"{','.join(names)}\nD,A,C,R,5,12.5,1953.0,32.7,55.1,7,x\n".encode("utf-16-le"))
    row = cast_types(read(spark, path, layout)).first()
    assert (row.id, row.year, row.area, row.floors, row.region) == (7, 1953, 12.5, 5, "R")


def test_missing_column_is_named(spark, folder):
    path = folder(a=f"{HEADER.replace('square', 'surface')}\n".encode("utf-16-le"))
    with pytest.raises(ValueError, match="square"):
        read(spark, path)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_each_file_is_bound_by_its_own_header(spark, folder, tmp_path, layout):
    """Column orders, a quoted header, marks, line ends, spanning records and packing mixed."""
    other = ",".join(reversed(RAW_COLUMNS))
    quoted = ",".join(f'"{c}"' for c in RAW_COLUMNS)
    folder(
        a=f"{HEADER}\n1,1,1,1,1,1,a,b,c,d\n".encode("utf-16-le"),
        b=f"{BOM}{other}\r\nd,c,b,a,1,1,1,1,1,2\r\n".encode("utf-16-le"),
        c=f'{quoted}\n3,1,1,1,1,1,a,b,"c\nc",d\n'.encode("utf-16-le"),
        d=f"extra,{HEADER},{HEADER}\nx,4,1,1,1,1,1,a,b,c,d{',y' * 10}\n".encode("utf-16-le"),
        e=b"",
    )
    (tmp_path / "f.csv.gz").write_bytes(gzip.compress(f"{other}\nd,c,b,a,1,1,1,1,1,5\n".encode("utf-16-le")))
    rows = {r.house_id: r for r in read(spark, str(tmp_path), layout).collect()}
    assert sorted(rows) == ["1", "2", "3", "4", "5"]
    assert all((r.region, r.locality_name, r.description) == ("a", "b", "d") for r in rows.values())
    assert [rows[i].address for i in "12345"] == ["c", "c", "c\nc", "c", "c"]
    assert all(r[CORRUPT] is None for r in rows.values())


@pytest.mark.parametrize("encoding", ["UTF-16LE", "UTF-8"])
@pytest.mark.parametrize("first", ["", BOM, BOM + BOM])
def test_marks_are_text_but_at_the_start_of_a_file(spark, folder, tiny_splits, encoding, first):
    body = "".join(f"{BOM}{i},1,2,1953.0,5,6,R,C,A{BOM},D\n" for i in range(200))
    path = folder(a=f"{first}{body}".encode(encoding))
    results = [
        sorted(map(repr, read(spark, path, layout, header=False, encoding=encoding).collect()))
        for layout in LAYOUTS
    ]
    assert results[0] == results[1] == results[2] and len(results[0]) == 200
    assert sum(f"{BOM}1" in r or "\\ufeff1" in r for r in results[0]) >= 100


def test_unknown_layout(spark, folder):
    with pytest.raises(ValueError, match="layout"):
        read(spark, folder(a=HEADER.encode("utf-16-le")), "columns")


def test_rows_of_separators_are_empty_not_corrupt(spark, folder):
    path = folder(a=f"{HEADER}\n,,,,,,,,,\n1,2,3,4,5,6,7,8,9,10\n".encode("utf-16-le"))
    assert tuple(read_report(read(spark, path)).first()) == (2, 0, 1)


def test_line_check_decides_per_file(spark, folder):
    row = '1,2,3,1953.0,5,6,"R, ""q""",C,A,D'
    path = folder(
        lf=f"{HEADER}\n{row}\n".encode("utf-16-le"),
        crlf=f"{HEADER}\r\n{row}\r\n".encode("utf-16-le"),
        mixed=f"{HEADER}\r\n{row}\n".encode("utf-16-le"),
        spanning=f'{HEADER}\n1,2,3,4,5,6,R,C,"A\nB",D\n'.encode("utf-16-le"),
        stray=f'{HEADER}\n1,2,3,4,5,6,R,C,5" pipe,D\n'.encode("utf-16-le"),
        # U+0A15 U+0400 holds the bytes of a line feed across two characters.
        shifted=f"{HEADER}\n1,2,3,4,5,6,R,C,ਕЀ,D\n".encode("utf-16-le"),
        surrogate=f"{HEADER}\n1,2,3,4,5,6,R,C,\ud83d,D\n".encode("utf-16-le", "surrogatepass"),
    )
    files = csv_files.file_sizes(spark, path).collect()
    profile = csv_lines.line_profile(spark, [f.path for f in files], "UTF-16LE").collect()
    got = {r.uri.rpartition("/")[2]: (r.line_end, r.one_line) for r in profile}
    assert got["lf.csv"] == ("\n", True)
    assert got["crlf.csv"] == ("\r\n", True)
    assert got["spanning.csv"] == ("\n", False)
    assert got["stray.csv"] == ("\n", False)
    assert {got[f"{n}.csv"][0] for n in ("mixed", "shifted", "surrogate")} == {None}
    rows = [
        sorted(map(repr, read(spark, path, layout).collect())) for layout in LAYOUTS
    ]
    assert rows[0] == rows[1] == rows[2]


def test_compressed_files_are_spread_and_named(spark, folder, tmp_path, caplog, capsys):
    content = f'{HEADER}\n1,2,3,1953.0,5,6,R,C,"A\nB",D\n'.encode("utf-16-le")
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(content))
    with caplog.at_level("WARNING"):
        rows = csv_files.read_raw(spark, str(tmp_path))
    assert [r.address for r in rows.collect()] == ["A\nB"]
    assert "a.csv.gz" in caplog.text
    rows.explain()
    assert "REBALANCE" in capsys.readouterr().out


def test_one_line_files_are_read_in_splits(spark, folder, tiny_splits):
    body = "".join(f"{i},1,2,1953.0,5,6,R,C,A,D\n" for i in range(400))
    path = folder(a=f"{HEADER}\n{body}".encode("utf-16-le"))
    split = read(spark, path, "auto")
    tasks = split.select(F.spark_partition_id()).distinct().count()
    assert tasks > 8
    assert read(spark, path).select(F.spark_partition_id()).distinct().count() == 1
    assert sorted(split.collect()) == sorted(read(spark, path).collect())
    assert sorted(read(spark, path, "lines").collect()) == sorted(split.collect())


def test_records_that_span_lines_are_the_same_in_every_layout(spark, folder, tiny_splits):
    end = "\r\n"
    body = "".join(f'{i},1,2,1953.0,5,6,R,C,"""A""{end}{end}B","D, ""x"""{end}' for i in range(60))
    good = f"{HEADER}{end}{body}"
    path = folder(
        good=(BOM + good).encode("utf-16-le"),
        twice=f"{good}{HEADER}{end}".encode("utf-16-le"),  # a row that looks like the header
        stray=f'{good}61,1,2,3,4,5,R,C,5" pipe,D{end}'.encode("utf-16-le"),
        unclosed=f'{good}62,1,2,3,4,5,R,C,A,"D{end}'.encode("utf-16-le"),
    )
    rows = [sorted(map(repr, read(spark, path, layout).collect())) for layout in LAYOUTS]
    assert rows[0] == rows[1] == rows[2]


def _messy_file(rnd: random.Random, header: bool, encoding: str) -> bytes:
    mess = rnd.choice([0, 1, 1, 2, 3])
    end = rnd.choice(["\n", "\r\n"])
    letters = "аб вг12.X\\'|\tЖ∀" + ("ਕЀĀ" if mess == 3 else "")

    def field() -> str:
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 10)))
        if rnd.random() < 0.5:
            stray = mess == 3 and rnd.random() < 0.05
            return text + (rnd.choice(['"', '""', "\r", 'a"b"', BOM]) if stray else "")
        text += rnd.choice(["", ",", '""', "a,b"])
        if mess and rnd.random() < 0.2:
            breaks = [end, end + end, end + " x", '""' + end, end + '""']
            text += rnd.choice(["\n", "\r\n", "\r"] if mess == 3 else breaks)
        quoted = f'"{text}"'
        if mess == 3 and rnd.random() < 0.05:
            quoted = rnd.choice([quoted[:-1], quoted[1:], quoted + "x", "x" + quoted, " " + quoted])
        return quoted

    records = [HEADER] if header else []
    for i in range(rnd.randint(1, 30)):
        width = rnd.choice([10] * 8 + [4, 12]) if mess else 10
        records.append(",".join([str(i)] + [field() for _ in range(width - 1)]))
        if rnd.random() < 0.03:
            records.append("")
    text = rnd.choice(["", BOM]) + end.join(records) + (end if rnd.random() < 0.8 else "")
    return text.encode(encoding)


@pytest.mark.parametrize(
    ("seed", "encoding", "header"), [(1, "UTF-16LE", True), (2, "UTF-16LE", False), (3, "UTF-8", True)]
)
def test_splits_give_the_same_rows_as_whole_files(
    spark, tmp_path, tiny_splits, seed, encoding, header
):
    rnd = random.Random(seed)
    folder = tmp_path / "папка с пробелом"
    folder.mkdir()
    for i in range(50):
        (folder / f"f{i}.csv").write_bytes(_messy_file(rnd, header, encoding))
    results = []
    for layout in LAYOUTS:
        raw = read(spark, str(folder), layout, header=header, encoding=encoding)
        rows = raw.select(*RAW_COLUMNS, F.col(CORRUPT).isNotNull().alias("bad")).collect()
        results.append(sorted(map(repr, rows)))
    assert results[0] == results[1] == results[2]
    assert len(results[0]) > 300


def test_written_files_are_bounded_and_read_back(spark, tmp_path):
    padded = spark.range(100).select(
        *[F.concat(F.lit(" "), F.col("id"), F.lit('\n"x", ')).alias(c) for c in RAW_COLUMNS]
    )
    path = str(tmp_path / "out")
    csv_files.write_raw(padded.coalesce(1), path, rows_per_file=30)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 4
    back = csv_files.read_raw(spark, path).select(*RAW_COLUMNS)
    assert sorted(back.collect()) == sorted(padded.collect())


def _encoded(text: str, encoding: str, mark: bool) -> bytes:
    return (BOM if mark else "").encode(encoding) + text.encode(encoding)


@pytest.mark.parametrize("header", [True, False])
@pytest.mark.parametrize("layout", LAYOUTS)
def test_files_of_several_encodings_read_as_one(spark, folder, layout, header):
    files, number = {}, 0
    for encoding in ("utf-16-le", "utf-16-be", "utf-8"):
        for mark in (False, True):
            rows = [f'{number + i},1,2,1953.0,5.5,6,"Область, ""Ж""","Город\r\nдва",A,"Дом № {i}"' for i in range(3)]
            number += 3
            text = "\r\n".join([HEADER, *rows] if header else rows) + "\r\n"
            files[f"{encoding}-{mark}"] = _encoded(text, encoding, mark)
    files["empty"] = b""
    found = read(spark, folder(**files), layout, header=header, encoding="auto").collect()
    assert sorted(int(r.house_id.lstrip(BOM)) for r in found) == list(range(number))
    # Spark's reader makes one line feed of a line end inside quotes.
    assert {(r.region, r.locality_name) for r in found} == {('Область, "Ж"', "Город\nдва")}
    assert all(r.house_id.isdigit() for r in found)


@pytest.mark.parametrize(("content", "want"), [
    (b"\xff\xfea\0", "UTF-16LE"), (b"\xfe\xff\0a", "UTF-16BE"), (b"\xef\xbb\xbfa", "UTF-8"), ("7,Ж\n".encode("utf-16-le"), "UTF-16LE"),
    ("7,Ж\n".encode("utf-16-be"), "UTF-16BE"), ("7,Ж\n".encode(), "UTF-8"), (b"7", "UTF-8"), (b"", "UTF-8"), ("Ж,Ж".encode("utf-16-le"), "UTF-16LE"),
])
def test_the_first_bytes_tell_the_encoding(spark, content, want):
    from cadastra.sources.encodings import told_by

    row = spark.createDataFrame([(bytearray(content),)], "c binary")
    assert row.select(told_by(F.col("c")).alias("e")).first().e == want
