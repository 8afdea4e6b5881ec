"""The sampled fits cover every well."""

import pytest
from pyspark.sql import functions as F

from wellfield.plans import fits
from wellfield.sources import fixtures as X

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["b10_monte_carlo", "b14_draws"])
def test_every_well_is_sampled(spark, name):
    wells = {r.wellid for r in X.well_header(spark, SF).select("wellid").collect()}
    rows = fits.QUERIES[name](spark, SF).groupBy("wellid").agg(F.count("*").alias("n")).collect()
    assert {r.wellid for r in rows} == wells and any(w % 5 for w in wells)
    assert all(r.n == 1 for r in rows) if name == "b10_monte_carlo" else all(r.n >= 100 for r in rows)
