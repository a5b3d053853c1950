"""Column types from one scan: the lattice, drifting columns with their first place, files in any order."""

import os

import pytest
from pyspark.sql import functions as F

from salesmart.session import scratch_path
from salesmart.sources import inference


def _files(spark, name, *bodies):
    folder = scratch_path(spark, f"t-infer-{name}")
    os.makedirs(folder)
    for i, body in enumerate(bodies):
        with open(os.path.join(folder, f"f{i}.csv"), "w") as fh:
            fh.write("Row ID;Order Date;Sales;Note\n" + "".join(line + "\n" for line in body))
    return folder


@pytest.mark.parametrize("values,want", [
    (["1", "-2", " 3 "], "bigint"), (["1", "2.50"], "decimal"), (["1", "2.5", "1e6"], "double"), (["9" * 19], "decimal"), (["2020-01-31", ""], "date"),
    (["31.01.2020"], "date_text"), (["31.01.2020", "2020-01-31"], "string"), (["1", "2020-01-01"], "string"), (["32.01.2020"], "string"),
    (["1", "x"], "string"), (["", None], "nothing"), (["1,5"], "string"), ([], "nothing"), ([".5"], "decimal"), (["+"], "string")])
def test_lattice(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v string").agg(F.collect_set(inference.value_class(F.col("v"))).alias("c"))
    assert df.select(inference.joined_type(F.col("c"))).first()[0] == want


def test_a_drifting_column_is_found_with_its_first_place(spark):
    good = [f"{i};08.11.2020;{i}.25;n{i}" for i in range(100)]
    bad = [*good[:3], "7;2020-11-08;a lot;", "8;08.11.2020;9.5;x", "9;;also bad;x"]
    for name, bodies in (("ab", (good, bad)), ("ba", (bad, good))):
        folder = _files(spark, name, *bodies)
        types = inference.column_types(spark, folder)
        rows = {r.column_name: r for r in types.collect()}
        assert [rows[c].type for c in ("Row ID", "Order Date", "Sales", "Note")] == ["bigint", "string", "string", "string"]
        assert (rows["Note"]["values"], rows["Note"].nulls, rows["Order Date"].nulls) == (105, 1, 1)
        found = {(r.column_name, r["class"]): r for r in inference.drifts(types).collect()}
        assert set(found) == {("Order Date", "date"), ("Sales", "string")}
        bad_file = "f1.csv" if name == "ab" else "f0.csv"
        assert all(r.file.endswith(bad_file) and r.block == 0 and r.line == 3 for r in found.values())
        assert found["Sales", "string"].n == 2 and found["Sales", "string"].usual == "decimal"


def test_read_inferred_and_empty_files(spark):
    df = inference.read_inferred(spark, _files(spark, "typed", ["1;08.11.2020;2.5;a", "2;;3;"]))
    assert dict(df.dtypes) == {"row_id": "bigint", "order_date": "date", "sales": "decimal(38,8)", "Note": "string"}
    assert sorted((r.row_id, str(r.order_date), float(r.sales)) for r in df.collect()) == [(1, "2020-11-08", 2.5), (2, "None", 3.0)]
    none = inference.column_types(spark, _files(spark, "none", [])).collect()
    assert [(r.type, r["values"], r.nulls) for r in none] == [("nothing", 0, 0)] * 4
