"""CSV files of any kind against pandas, whole and cut into many blocks."""

from __future__ import annotations

import random
import re
from decimal import Decimal

import pandas as pd
import pytest

from tallyroom.sources.csv_file import read_csv

KINDS = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string", "uint64": "decimal(20,0)"}

MADE = {
    "whole numbers": "a,b\n1,2\n-3,+4\n007,9223372036854775807\n",
    "whole numbers with gaps": "a,b\n1,\n,2\n3,NA\n",
    "numbers": "a,b,c\n1.5,.5,5.\n1e3,-2E-2,inf\n3,nan,-Infinity\n",
    "truth": "a,b\nTrue,true\nFALSE,\nfalse,False\n",
    "mixed": "a,b,c,d\n1,True,1,1.5\nx,1,1d,1f\n2.5,False,2,2\n",
    "nothing but gaps": "a,b\n,NA\nnull,1\n",
    "no rows": "a,b\n",
    "large whole numbers": "a,b,c\n18446744073709551615,9223372036854775808,99999999999999999999999\n1,-1,1\n",
    "large ones with gaps": "a,b\n18446744073709551615,1\n,2\n",
    "text": "name,x\n\"Halo, \"\"the\"\" game\",1\nplain,2\n' single ',3\n",
    "line breaks": 'a,b\n"one\ntwo",1\n"three\n\n,four",2\nfive,3\n"six\n",4\n',
    "line breaks in a header": '"a\nb",c\n1,"x\ny"\n2,z\n',
    "carriage returns": 'a,b\r\n1,x\r\n"2","y"\r\n3,"z"\r\n',
    "blank lines": "a,b\n\n1,2\n  \n\n3,4\n\t\n",
    "absent fields": "a,b,c\n1,2\n3\n4,5,6\n",
    "quoted gaps": 'a,b,c\n"",1,"NA"\n"x",2,"3"\n',
    "white space": "a,b,c\n 1, x,1.5 \n2 ,y , 2\n",
    "repeated and absent names": "a,a,,b,a\n1,2,3,4,5\n",
    "byte order mark": "﻿a,b\n1,é\n2,日本\n",
    "no last line end": 'a,b\n1,2\n"3\n4",5',
    "only quoted": '"a","b"\n"1","x ""y"""\n"2","\n"\n',
}


def same(value, expected):
    if expected is None or expected != expected:
        return value is None
    if isinstance(value, Decimal):
        return int(value) == int(expected)
    return value == expected and isinstance(value, bool) == isinstance(expected, bool)


def check(spark, path, theirs, **options):
    ours = read_csv(spark, path, position="place", **options)
    assert ours.columns == [*theirs.columns, "place"]
    rows = sorted(ours.collect(), key=lambda r: r.place)
    assert [r.place for r in rows] == list(range(len(theirs)))
    for name, kind in theirs.dtypes.items():
        if len(theirs):
            assert ours.schema[name].dataType.simpleString() == KINDS[str(kind)], (name, kind)
        expected = [v.item() if hasattr(v, "item") else v for v in theirs[name]]
        if str(kind) == "object":
            # Text here keeps its spelling: pandas turns truth values beside gaps into its own, and lets a gap beside
            # whole numbers beyond longs be an empty text.
            expected = [None if v is None or v != v or v == "" else str(v) for v in expected]
        got = [r[name] for r in rows]
        if {type(v) for v in theirs[name]} & {bool}:
            got = [v.capitalize() if isinstance(v, str) else v for v in got]
        assert all(map(same, got, expected)), (name, got, expected)
    return ours


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("name", MADE)
def test_made_files(spark, tmp_path, name):
    path = tmp_path / "made.csv"
    path.write_bytes(MADE[name].encode())
    check(spark, str(path), pd.read_csv(path))


def test_files_cut_into_many_blocks(spark, tmp_path, small_blocks):
    """Blocks of 64 bytes end inside quoted fields, between quotes and inside line breaks."""
    rng = random.Random(3)
    words = ["plain", "two\nlines", 'a "quoted" word', "\n\n", '"', "é,ü", "", "x" * 90, "a\nb\nc\nd " * 9]
    rows = [(i, rng.choice(words), rng.choice([None, 1.5, 2.0]), rng.choice(words)) for i in range(120)]
    path = tmp_path / "cut.csv"
    pd.DataFrame(rows, columns=["id", "s", "x", "t"]).to_csv(path, index=False, lineterminator="\n")
    theirs = pd.read_csv(path)
    ours = check(spark, str(path), theirs)
    assert ours.rdd.getNumPartitions() > 0
    scan = spark.read.text(str(path))
    assert scan.rdd.getNumPartitions() > 50  # no task has the whole file


def test_folders_of_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    parts = []
    for i in range(5):
        part = pd.DataFrame({"a": [f"{i}\n{j}" for j in range(3)], "b": range(3 * i, 3 * i + 3)})
        part.to_csv(folder / f"part-{i}.csv", index=False)
        parts.append(part)
    check(spark, str(folder), pd.concat(parts, ignore_index=True))
    (folder / "part-9.csv").write_text("a,c\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        read_csv(spark, str(folder))


@pytest.mark.parametrize(
    ("text", "error"),
    [('a,b\n1,"open\n2,3\n', "never ends"), ("a,b\n1,2,3\n", "too many fields"), ("", "empty")],
)
def test_broken_files_are_errors(spark, tmp_path, text, error):
    path = tmp_path / "broken.csv"
    path.write_text(text)
    with pytest.raises(Exception, match=re.compile(error)):
        read_csv(spark, str(path)).collect()


def test_stated_types(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,2\nNA,x\n")
    df = read_csv(spark, str(path), types={"a": "double", "b": "string"})
    assert dict(df.dtypes) == {"a": "double", "b": "string"}
    assert sorted(map(str, map(tuple, df.collect()))) == ["(1.0, '2')", "(None, 'x')"]
