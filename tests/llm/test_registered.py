import pytest
from oracle import connect, differences

from lakeloom.llm import CASES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, (_, sql) in CASES.items() if sql])
def test_query_equals_its_sql(spark, name):
    run, sql = CASES[name]
    assert differences(run(spark, SF), connect(SF), sql) == []


@pytest.mark.parametrize("name", [n for n, (_, sql) in CASES.items() if not sql])
def test_query_gives_rows(spark, name):
    assert CASES[name][0](spark, SF).count() > 0


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in CASES) == list(range(1, 14))
