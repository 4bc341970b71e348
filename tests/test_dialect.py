"""CSV files in several dialects, found out from their beginning."""

import gzip
from pathlib import Path

import pytest
from playpulse.schema import RAW_SCHEMAS
from playpulse.sources.dialect import SAMPLE_BYTES, Dialect, detect, of_text
from playpulse.sources.raw_csv import read_csv, read_raw, write_raw
from support import values
from test_warehouse import JOB_FAILURE, PLAYERS, PURCHASES, SESSIONS

TEXTS = {"players": PLAYERS, "sessions": SESSIONS, "purchases": PURCHASES}


def rewritten(text, sep):
    """The same table with another separator; fields that hold it are quoted."""
    import csv
    import io

    out = io.StringIO()
    csv.writer(out, delimiter=sep, lineterminator="\n").writerows(csv.reader(io.StringIO(text)))
    return out.getvalue()


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
@pytest.mark.parametrize("infer", [False, True])
def test_any_separator_loads_the_same_tables(spark, tmp_path, sep, infer):
    for name, text in TEXTS.items():
        (tmp_path / f"{name}.csv").write_text(text)
    want = read_raw(spark, str(tmp_path), infer=infer)
    other = tmp_path / "other"
    other.mkdir()
    for name, text in TEXTS.items():
        (other / f"{name}.csv").write_text(rewritten(text, sep))
    got = read_raw(spark, str(other), infer=infer)
    for name, df in want.named().items():
        assert got.named()[name].schema == df.schema
        assert sorted(values(got.named()[name]), key=str) == sorted(values(df), key=str)


@pytest.mark.parametrize(
    ("text", "columns", "want"),
    [
        ("a;b\n1,5;x\n2,5;y\n", None, Dialect(";")),
        ("a,b\n1;2,x\n", None, Dialect(",")),
        ("a|b|c\n1|2|3\n", None, Dialect("|")),
        ("'a','b'\n'1, one','2'\n", None, Dialect(",", "'")),
        ('"a";"b"\n"1;one";"2"\n', None, Dialect(";")),
        ('a,b\n"line\nbreak; and | signs",2\n', None, Dialect(",")),
        ("1,2\n3,4\n", None, Dialect(",", '"', False)),
        ("x,2024-01-05\ny,2024-01-06\n", None, Dialect(",", '"', False)),
        ("only\nvalues\n", None, Dialect(",")),
        ("a\tb\n", ["a", "b"], Dialect("\t")),
        ("p1;DE\np2;FR\n", ["player", "country"], Dialect(";", '"', False)),
        ("a,b;c,d\n", ["a,b", "c,d"], Dialect(";")),
        ("﻿a;b\n1;2\n".removeprefix("﻿"), ["a", "b"], Dialect(";")),
        ("", ["a"], None),
        ("O'Brien,it's\n1,2\n", None, Dialect(",")),
    ],
)
def test_dialects(text, columns, want):
    assert of_text(text, columns) == want


def test_files_without_names(spark, tmp_path):
    (tmp_path / "t.csv").write_text("p1;DE;4\np2;FR;5\n")
    df = read_csv(spark, str(tmp_path / "t.csv"), "player string, country string, level int")
    assert sorted(values(df)) == [("p1", "DE", 4), ("p2", "FR", 5)]
    short = tmp_path / "short.csv"
    short.write_text("p1;DE\n")
    with pytest.raises(JOB_FAILURE):
        read_csv(spark, str(short), "player string, country string, level int").collect()


def test_quotes_of_the_other_kind(spark, tmp_path):
    (tmp_path / "t.csv").write_text("'a';'b'\n'1; one';'it''s'\n'2';'x'\n")
    assert sorted(values(read_csv(spark, str(tmp_path / "t.csv"), "a string, b string"))) == [
        ("1; one", "it's"),
        ("2", "x"),
    ]


def test_compressed_and_long_files(spark, tmp_path):
    lines = ["a|b", *(f"{i}|text {i}" for i in range(20_000))]
    text = "\n".join(lines) + "\n"
    assert len(text) > 3 * SAMPLE_BYTES
    (tmp_path / "plain.csv").write_text(text)
    (tmp_path / "packed.csv.gz").write_bytes(gzip.compress(text.encode()))
    for name in ("plain.csv", "packed.csv.gz"):
        assert detect(spark, str(tmp_path / name)) == Dialect("|")
        assert read_csv(spark, str(tmp_path / name)).count() == 20_000


def test_contradictory_files_raise(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a;b\n1;2\n")
    (tmp_path / "2.csv").write_text("a|b\n3|4\n")
    with pytest.raises(ValueError, match="differently"):
        read_csv(spark, str(tmp_path))


def test_a_file_outside_the_sample_is_checked_when_read(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i:02}.csv").write_text(f"a;b\n{i};x\n")
    assert read_csv(spark, str(tmp_path), "a int, b string").count() == 40
    odd = [f for i in range(1, 39) if (f := f"{i:02}.csv") not in _sampled(spark, tmp_path)][0]
    (tmp_path / odd).write_text("a|b\n1|x\n")
    df = read_csv(spark, str(tmp_path), "a int, b string")
    with pytest.raises(JOB_FAILURE):
        df.collect()


def _sampled(spark, folder: Path):
    from playpulse.sources.dialect import samples

    return {name for name, _ in samples(spark, str(folder))}


def test_empty_files_and_own_output(spark, tmp_path):
    for name, text in TEXTS.items():
        (tmp_path / f"{name}.csv").write_text(text)
    raw = read_raw(spark, str(tmp_path))
    write_raw(type(raw)(raw.players, raw.sessions.limit(0), raw.purchases), str(tmp_path / "copy"))
    again = read_raw(spark, str(tmp_path / "copy"))
    assert again.sessions.count() == 0 and again.players.count() == 3
    (tmp_path / "nothing.csv").write_text("")
    assert read_csv(spark, str(tmp_path / "nothing.csv"), RAW_SCHEMAS["players"]).count() == 0
