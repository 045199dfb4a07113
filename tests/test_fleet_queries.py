import oracle
import pytest

from drayage.plans import queries as fleet

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(fleet.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    oracle.compare(spark, fleet.queries()[name], fleet.oracle_sql()[name], SF)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["vin", "model", "audit_date", "km_per_liter", "baseline_kmpl", "status", "fuel_type"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_fuel_row_is_clean_or_labelled_once(spark):
    t = fleet.Tables(spark, SF)
    assert t.fuel().count() == t.raw("fuel").count()
