"""Schema-aligned union (UN-1..6, PRJ-2..4)."""

from hypothesis import given, settings, strategies as st

from meterlake.operators import align


def test_first_seen_order_and_mismatch(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("2", 3)], "id string, extra int")
    al = align.analyze({"A": a, "B": b})
    assert al.columns == ["id", "name", "extra"]
    assert al.mismatched == {"id"}
    u = align.aligned_union({"A": a, "B": b})
    assert [f.dataType.simpleString() for f in u.schema.fields] == ["string", "string", "int"]
    assert sorted(map(tuple, u.collect()), key=str) == sorted([("1", "x", None), ("2", None, 3)], key=str)


def test_nullable_array_counts_as_same_type(spark):
    # D-10: compared by simpleString, so element nullability is not a mismatch
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
    a = spark.createDataFrame([([1, None],)], "v array<int>")
    b = spark.createDataFrame([([1],)], StructType([StructField("v", ArrayType(IntegerType(), False))]))
    assert b.schema["v"].dataType.containsNull is False
    assert align.analyze({"A": a, "B": b}).mismatched == frozenset()


def test_case_insensitive_names_first_spelling_wins(spark):
    a = spark.createDataFrame([(1,)], "Id int")
    b = spark.createDataFrame([(2,)], "ID int")
    u = align.aligned_union({"A": a, "B": b})
    assert u.columns == ["Id"] and u.count() == 2


def test_scalar_and_complex_mismatches_become_text(spark):
    # D-9: scalars are cast, complex types become JSON
    a = spark.createDataFrame([(1, {"k": 1}, [1, 2])], "i int, m map<string,int>, s array<int>")
    b = spark.createDataFrame([("x", "y", "z")], "i string, m string, s string")
    r = {tuple(x) for x in align.aligned_union({"A": a, "B": b}).collect()}
    assert r == {("1", '{"k":1}', "[1,2]"), ("x", "y", "z")}


def test_global_takes_primary_only_and_mixed_dedups(spark):
    n = spark.createDataFrame([(1,), (2,)], "k int")
    assert align.consolidate({"A": n, "B": n}, align.GLOBAL).count() == 2
    assert align.consolidate({"A": n, "B": n}, align.MIXED, ["k"]).count() == 2
    assert align.consolidate({"A": n, "B": n}, align.MIXED).count() == 4  # no key: as REGIONAL


def test_missing_everywhere_and_discovery(spark):
    x = spark.createDataFrame([(1,)], "k int")
    cats = {"A": {"s.t": x, "__s.t": x, "s.__t": x, "metadata.t": x}, "B": {"s.t": x, "s.only_b": x}}
    rule = lambda name: ("REGIONAL", None)
    views, _, _ = align.consolidate_all(cats, rule)
    assert set(views) == {"s.t"}  # D-14: discovery from the primary catalog
    views, _, _ = align.consolidate_all(cats, rule, discover="all")
    assert set(views) == {"s.t", "s.only_b"}
    assert align.aligned_union({"A": None, "B": None}) is None


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=30), min_size=1, max_size=4))
def test_union_row_count_is_sum(spark, sizes):
    frames = {f"c{i}": spark.range(n).selectExpr("id", f"'{i}' AS tag") for i, n in enumerate(sizes)}
    assert align.aligned_union(frames).count() == sum(sizes)


def test_publish_views_are_queryable(spark):
    from meterlake.sources.views import publish_all
    x = spark.createDataFrame([(1,), (2,)], "k int")
    names = publish_all({"s.t": x, "s.u": x.filter("k > 1")})
    assert names == ["s__t", "s__u"]
    assert spark.sql("SELECT count(*) AS n FROM s__u").first().n == 1


def test_scale_settings():
    from meterlake.session import scale_settings
    conf = scale_settings(100 * 1024 ** 4, executors_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert scale_settings(10, 4)["spark.sql.shuffle.partitions"] == "8"


def test_every_type_pair_reconciles_to_text(spark):
    # D-9: int / string / decimal / date / array / map / struct against each other
    import datetime as dt
    import decimal
    a = spark.createDataFrame(
        [(1, "s", decimal.Decimal("1.50"), dt.date(2024, 1, 2), [1, 2], {"k": 1}, (1, "x"))],
        "c1 int, c2 string, c3 decimal(5,2), c4 date, c5 array<int>, c6 map<string,int>, c7 struct<a:int,b:string>")
    b = spark.createDataFrame([("t", 2, 3, "d", "e", "f", "g")],
                              "c1 string, c2 int, c3 int, c4 string, c5 string, c6 string, c7 string")
    u = align.aligned_union({"A": a, "B": b})
    assert all(f.dataType.simpleString() == "string" for f in u.schema.fields)
    rows = {tuple(r) for r in u.collect()}
    assert ("1", "s", "1.50", "2024-01-02", "[1,2]", '{"k":1}', '{"a":1,"b":"x"}') in rows
    assert ("t", "2", "3", "d", "e", "f", "g") in rows


def test_struct_json_keeps_microseconds(spark):
    import datetime as dt
    a = spark.createDataFrame([((dt.datetime(2024, 1, 1, 0, 0, 0, 123456),),)], "s struct<t:timestamp_ntz>")
    b = spark.createDataFrame([("x",)], "s string")
    got = {r.s for r in align.aligned_union({"A": a, "B": b}).collect()}
    assert '{"t":"2024-01-01T00:00:00.123456"}' in got
