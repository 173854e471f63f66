"""What references are told from travels as one number, without loss of what they show."""

from __future__ import annotations

import itertools

from linkledger.adapters import star

_LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
_WHEN = "TIMESTAMP_NTZ '1997-01-01'"


def _tables(spark, folder, lines, parts):
    rows = spark.createDataFrame(lines, _LINES.rsplit(",", 1)[0]).selectExpr("*", f"{_WHEN} AS l_shipdate")
    rows.write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_size int").write.parquet(f"{folder}/part.parquet")
    return str(folder)


def _told(value, by):
    """The remainder as SQL gives it: with the sign of the number."""
    return None if value is None else abs(value) % by * (1 if value >= 0 else -1)


def test_everything_a_reference_uses_comes_back(spark, tmp_path):
    parts = [(1, "Brand#1", 0), (2, "Brand#25", 39), (-3, "Brand#0", -7), (7, None, None), (121, "Brand#99", 10)]
    some = itertools.product([p[0] for p in parts], [None, -241, -1, 0, 3, 119, 120, 1_000_003], [None, -61, 0, 1, 7, 60, 2**31 - 1], [None, "A", "R", "N"], [None, "O", "F"])
    lines = [(i, *row) for i, row in enumerate(some)]
    sf = _tables(spark, tmp_path, lines, parts)
    source = star._reference_source(spark, sf, [])
    assert source.columns == ["orderkey", star._REF_CODE]
    found = source.selectExpr("orderkey", *star._unpacked(star._REF_CODE, [*star._LINE_TERMS, *star._PART_TERMS]))
    got = {r.orderkey: r for r in found.collect()}
    of_part = {key: (None if brand is None else int(brand[6:]), size) for key, brand, size in parts}
    assert len(got) == len(lines)
    for key, part, supp, line, flag, status in lines:
        r, (brand, size) = got[key], of_part[part]
        assert (r.l_partkey, r.l_suppkey, r.l_linenumber, r.p_size) == (_told(part, 5), _told(supp, 120), _told(line, 60), _told(size, 10))
        assert (r.returned, r.closed) == ({"A": 0, "R": 1}.get(flag, 3), 0 if status == "O" else 1)
        assert r.brand == (brand if brand is None or brand <= 26 else 27 + brand % 3)


def test_joins_and_shuffles_carry_the_number_alone(spark, tmp_path):
    sf = _tables(spark, tmp_path, [(1, 1, 1, 1, "A", "O")], [(1, "Brand#1", 1)])
    spark.createDataFrame([(1, "F", "1-URGENT", 1)], "o_orderkey long, o_orderstatus string, o_orderpriority string, o_custkey long").selectExpr(
        "*", f"{_WHEN} AS o_orderdate").write.parquet(f"{sf}/orders.parquet")
    spark.createDataFrame([(1, "c", 0, "BUILDING")], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{sf}/customer.parquet")
    spark.createDataFrame([(0, "n")], "n_nationkey int, n_name string").write.parquet(f"{sf}/nation.parquet")
    spark.createDataFrame([(1,)], "s_suppkey long").write.parquet(f"{sf}/supplier.parquet")
    rows = star.connections(spark, sf)
    assert rows.count() == 1
    below = rows._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    moved = [line for line in below.split("\n") if "Union" not in line][1]
    assert "ref_code" in moved and not any(c in moved for c in ("l_suppkey", "l_returnflag", "p_size", "brand"))
