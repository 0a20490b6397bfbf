"""Whole jobs over records where one student, course and session holds a third of the rows."""

import random

import pytest

from limpid.operators import drill, pairs
from limpid.plans.cleaning import clean_records
from limpid.plans.scoring import scores_d, scores_n
from limpid.rules import Rules

KEY = ["COD_ETU", "COD_SES", "COD_ELP"]


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(9000):
        hot = i % 3 == 0
        student = "10" if hot else str(rnd.randrange(2000))
        course = "MATH0001" if hot else f"MATH{rnd.randrange(30):04d}"
        session = "2" if hot else rnd.choice("12")
        rows.append((i, "2015", student, course, rnd.choice(["12", "9,5", "x"]), rnd.choice(["V", "AJ"]), session, "OK"))
    rnd.shuffle(rows)
    schema = (
        "line_no long, COD_ANU string, COD_ETU string, COD_ELP string, NOT_ELP string, COD_TRE string, "
        "COD_SES string, row_status string"
    )
    return spark.createDataFrame(rows, schema).repartition(16).cache()


@pytest.fixture(scope="module")
def pdf(skewed):
    return skewed.toPandas().sort_values("line_no")


def test_cleaning_keeps_the_first_of_every_key(skewed, pdf):
    kept = {r.line_no for r in clean_records(skewed, carry=("line_no",)).select("line_no").collect()}
    assert kept == set(pdf.drop_duplicates(subset=KEY)["line_no"])


def test_duplicate_members_are_all_there_in_order(skewed, pdf):
    found = [r.line_no for r in drill.duplicate_members(skewed, ("COD_ETU", "COD_ELP", "COD_SES"), "line_no").collect()]
    order = ["COD_ETU", "COD_ELP", "COD_SES", "line_no"]
    assert found == list(pdf[pdf.duplicated(subset=KEY, keep=False)].sort_values(order)["line_no"])


def test_pair_flag(skewed, pdf):
    sessions = pdf.groupby(["COD_ETU", "COD_ELP"])["COD_SES"].agg(set)
    lonely = {k for k, s in sessions.items() if "2" in s and "1" not in s}
    expected = {n for n, e, c in zip(pdf["line_no"], pdf["COD_ETU"], pdf["COD_ELP"]) if (e, c) in lonely}
    marked = pairs.flag_second_without_first(skewed, "bad").where("bad").select("line_no").collect()
    assert {r.line_no for r in marked} == expected
    assert len(expected) > 3000


def test_scores(skewed, pdf):
    distinct = len(pdf.drop_duplicates(subset=KEY))
    assert scores_d(skewed, helpers=("line_no",)).first()["Unicité"] == round(100 * distinct / len(pdf), 2)
    row = scores_n(skewed, Rules(compat=False), helpers=("line_no",)).first()
    assert row.unicite == pytest.approx(distinct / len(pdf))
    share = pdf["COD_SES"].value_counts(normalize=True)
    assert row.distribution == pytest.approx(1 - abs(share["1"] - share["2"]))
