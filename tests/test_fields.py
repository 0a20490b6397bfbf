"""Edge values of every field rule."""

import pytest
from pyspark.sql import functions as F

from limpid.functions import fields as ff
from limpid.functions import text as ft
from limpid.operators import cleaners as cl
from limpid.operators.parsing import parse_lines, ragged_records

HEADER = "COD_ANU,COD_ETU,COD_ELP,NOT_ELP,COD_TRE,COD_SES"


def _map(spark, column, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_year(spark):
    cases = {
        None: (None, True),
        "": (None, True),
        " 2015": (None, True),
        "AN2015": (None, True),
        "2015-2016": ("2015-2016", False),
        "2015-1999": ("2015-1999", False),
        "2015": ("2015-2016", True),
        "15/16": ("2015-2016", True),
        "97/98": ("2097-2098", True),
        "99/00": ("2099-2000", True),
        "9999": ("9999-10000", True),
    }
    assert _map(spark, ff.academic_year, cases) == [c[0] for c in cases.values()]
    assert _map(spark, ff.year_corrected, cases) == [c[1] for c in cases.values()]


def test_grade(spark):
    cases = {
        "14,5": 14.5, " 12 ": 12.0, "007": 7.0, "25": 25.0, "-3": None, "ABS": None, ".5": None,
        "14.": None, "1e1": None, "": None, None: None, "12d": None, "14,5,1": None,
    }
    assert _map(spark, ff.grade_value, cases) == list(cases.values())


def test_to_number_takes_what_pandas_takes(spark):
    pd = pytest.importorskip("pandas")
    texts = [
        " 12 ", "1e5", ".5", "14.", "+3", "inf", "-Infinity", "0x1A", "12d", "1_000", "", "14,5", "-.5",
        "- 5", "INF", "infin", "1E+3", "1e", "True", "1.0", "nan",
    ]
    expected = pd.to_numeric(pd.Series(texts), errors="coerce")
    assert _map(spark, ft.to_number, texts) == [None if pd.isna(x) else x for x in expected]


def test_to_int_cuts_fractions(spark):
    cases = {
        "1": 1, "1.0": 1, "1.7": 1, " 1 ": 1, "-2.9": -2, "+3": 3, ".5": 0, "2.": 2, "": None, "x": None,
        None: None, "+": None, "1e1": None, "99999999999": None, "\t7": 7, "1 2": None,
    }
    assert _map(spark, ft.to_int, cases) == list(cases.values())


def test_blank_tests(spark):
    texts = ["a", " ", "", " ", "\t\x1f", " x ", None]
    python = [t is not None and t.strip() != "" for t in texts]
    assert _map(spark, ft.has_text, texts) == python
    assert _map(spark, ft.is_missing_text, ["", " ", "NULL", "xNonex", "none", "a", None]) == [
        True, True, True, True, False, False, True,
    ]


def test_percent_text(spark):
    df = spark.createDataFrame([(1.234,), (-0.5,), (None,)], "v double")
    assert [r[0] for r in df.select(ft.percent_text(F.col("v"), signed=True)).collect()] == ["+1.23%", "-0.50%", None]


def test_ingestion(lines):
    texts = {
        "2015,1,MATH1001,14.5,V,1": ("OK", "14.5", "V", "1"),
        "2015,1,MATH1001,14,5,V,1": ("FIXED", "14,5", "V", "1"),
        "2015,1,MATH1001,14.5,V,1,": ("FIXED", "14.5,V", "1", ""),
        "2015,1,MATH1001,14.5,V,1,a,b": None,
        "a,b": None,
        "": None,
        ",1,MATH1001,14.5,V,1": ("OK", "14.5", "V", "1"),
    }
    raw = lines([HEADER, *texts])
    found = {r.line_no: r for r in parse_lines(raw).collect()}
    for i, expected in enumerate(texts.values(), 1):
        row = found.get(i)
        assert (row and (row.row_status, row.NOT_ELP, row.COD_TRE, row.COD_SES)) == expected
    assert found[7].COD_ANU == ""
    kept = {r.line_no: r for r in parse_lines(raw, keep_invalid=True).collect()}
    assert set(kept) == set(range(1, 8))
    assert kept[5].row_status == "INVALID" and kept[5].COD_ANU is None


def test_ragged_lines_as_pandas_reads_them(spark, lines, tmp_path):
    pd = pytest.importorskip("pandas")
    names = ["COD_ANU", "COD_ETU", "COD_ELP", "NOT_ELP", "COD_TRE", "COD_SES", "EXTRA"]
    texts = ["2015,x1,M,14.5,V,1", "2016,x2,M,14,5,V,1", "a,b", "", '"q,x",x3, M ,NA,None,2', "NULL,,n/a,1,V,s,z"]
    path = tmp_path / "ragged.txt"
    path.write_text("\n".join([HEADER, *texts]))
    pdf = pd.read_csv(path, header=None, names=names, engine="python", skiprows=1, dtype=str)
    expected = [tuple(None if pd.isna(x) else x for x in row) for row in pdf.itertuples(index=False)]
    found = ragged_records(lines(texts)).orderBy("line_no").select(*names).collect()
    assert [tuple(r) for r in found] == expected
    from limpid.sources.read import read_ragged

    again = read_ragged(spark, str(path))
    assert sorted(map(repr, (tuple(r) for r in again.select(*names).collect()))) == sorted(map(repr, expected))


def test_too_many_fields_are_marked(lines):
    row = ragged_records(lines(["1,2,3,4,5,6,7,8,9"])).first()
    assert row.too_many_fields and row.EXTRA == "7"


def test_cleaners(records):
    df = records(
        [
            ("2015", "1", " math1001 ", "9", "V", "1"),
            ("2015", "2", "MAT-1001", "10", "AJ", "1.0"),
            ("2015", "3", "MATH100", "9", " v ", "3"),
            ("2015", "4", "", "25", "xx", ""),
            ("2015", "5", None, None, None, "x"),
            ("2015", "6", "MATH1006", "ABS", "", "2"),
        ]
    )
    out = {int(r.COD_ETU): r for r in cl.run_cleaners(df).collect()}
    assert [out[i].COD_ELP for i in range(1, 7)] == ["MATH1001", None, None, None, None, "MATH1006"]
    assert [out[i].elp_invalid_format for i in range(1, 7)] == [False, True, True, True, True, False]
    assert [out[i].note_incoherent for i in range(1, 4)] == [True, True, False]
    assert out[4].note_out_of_range is True and out[4].NOT_ELP == 25.0 and out[5].note_out_of_range is None
    assert [out[i].COD_TRE for i in range(1, 7)] == ["V", "AJ", "V", None, None, None]
    assert [out[i].cod_tre_invalid for i in range(1, 7)] == [False, False, False, True, False, True]
    assert [out[i].COD_SES for i in range(1, 7)] == [1, 1, None, None, None, 2]
    assert [out[i].cod_ses_missing for i in range(1, 7)] == [False, False, False, True, True, False]
    assert [out[i].cod_ses_invalid for i in range(1, 7)] == [False, False, True, None, None, False]
    assert [out[i].row_status for i in range(1, 7)] == ["OK", "OK", "FLAGGED", "FLAGGED", "FLAGGED", "FLAGGED"]
    assert [(out[i].note_missing_s1, out[i].note_missing_s2) for i in (1, 5, 6)] == [
        (False, False), (None, None), (False, True),
    ]


def test_row_status_is_added_when_absent(records):
    df = records([("2015", "1", "MATH1001", "9", "V", "1")]).drop("row_status")
    assert cl.clean_status(df).first().row_status == "OK"
