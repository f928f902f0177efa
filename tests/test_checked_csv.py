"""CSV scans with rows that do not fit."""

import pytest

from lendgrid.sources.checked_csv import RECORD, checked_csv
from lendgrid.sources.schemas import SCHEMAS

HEADER = "SK_ID_BUREAU,MONTHS_BALANCE,STATUS,note,score"
BALANCE = SCHEMAS["bureau_balance"]


def scan(spark, tmp_path, lines, limit=1.0, header=HEADER):
    (tmp_path / "t.csv").write_text("\n".join([header, *lines]) + "\n")
    return checked_csv(spark, str(tmp_path / "t.csv"), BALANCE, str(tmp_path / "out"), limit)


def test_types_and_undeclared_columns(spark, tmp_path):
    table = scan(spark, tmp_path, ["1,-1,C,hello,2.5", '2,,"",,NaN', "3,-3,X,7,4", '"4","-4","0","a, b",'], 0.0)
    assert dict(table.rows.dtypes) == {"SK_ID_BUREAU": "bigint", "MONTHS_BALANCE": "int", "STATUS": "string", "note": "string", "score": "double"}
    got = {r[0]: tuple(r)[1:] for r in table.rows.collect()}
    assert got == {1: (-1, "C", "hello", 2.5), 2: (None, None, None, None), 3: (-3, "X", "7", 4.0), 4: (-4, "0", "a, b", None)}
    assert table.rejects.count() == 0


def test_rows_that_do_not_fit_are_kept_apart(spark, tmp_path):
    lines = ["1,-1,C,x,1", "x,-1.5,C,y,2", "3,99999999999,0,z,3", "4,-1,C", "5,-1,C,x,1,extra", "6,-2,0,w,4"]
    table = scan(spark, tmp_path, lines)
    assert sorted(r["SK_ID_BUREAU"] for r in table.rows.collect()) == [1, 6]
    assert {r["column"]: r["n"] for r in table.failures().collect()} == {"SK_ID_BUREAU": 1, "MONTHS_BALANCE": 2, RECORD: 2}
    rejects = {r["fields"]["SK_ID_BUREAU"]: r for r in table.rejects.collect()}
    assert sorted(rejects) == ["3", "4", "5", "x"]
    assert (rejects["x"]["failed"], rejects["x"]["fields"]["MONTHS_BALANCE"], rejects["x"]["record"]) == (["SK_ID_BUREAU", "MONTHS_BALANCE"], "-1.5", None)
    assert rejects["5"]["record"] == "5,-1,C,x,1,extra"


def test_the_limit(spark, tmp_path):
    lines = [f"{i},{'bad' if i < 3 else -1},C,x,1" for i in range(10)]
    with pytest.raises(ValueError, match="3 of 10 rows.*MONTHS_BALANCE.*3"):
        scan(spark, tmp_path, lines, 0.29)
    assert spark.read.parquet(str(tmp_path / "out")).where("NOT _ok").count() == 3
    (tmp_path / "again").mkdir()
    assert scan(spark, tmp_path / "again", lines, 0.3).rows.count() == 7


def test_a_file_with_another_header_is_an_error(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "a.csv").write_text("SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,-1,C\n")
    (folder / "b.csv").write_text("SK_ID_BUREAU,STATUS,MONTHS_BALANCE\n1,C,-1\n")
    with pytest.raises(Exception, match="(?i)header"):
        checked_csv(spark, str(folder), BALANCE, str(tmp_path / "out"), 1.0)


def test_an_empty_table(spark, tmp_path):
    table = scan(spark, tmp_path, [], 0.0)
    assert table.rows.count() == 0 and table.rejects.count() == 0 and table.failures().count() == 0
