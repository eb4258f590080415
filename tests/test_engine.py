import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strataq import Catalog, Query, QueryRefused, ScanLimitExceeded, Store, UnknownTable, UnsupportedJoin, UnsupportedWhere, agg
from strataq.functions import normalise_like
from strataq.operators import predicates as P
from strataq.oracle import ORACLE
from strataq.plans.inspect import plan_text
from strataq.queries import QUERIES
from strataq.streaming import stream_query

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents labels".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def rounded(rows):
    return sorted((tuple(round(v, 4) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, duck, name):
    df, want = QUERIES[name](spark, DATA), duck.execute(ORACLE[name])
    assert df.columns == [c[0] for c in want.description]
    assert rounded(tuple(r) for r in df.collect()) == rounded(want.fetchall())


def test_full_join_of_whole_tables(spark):
    rows, size = QUERIES["join_full"](spark, DATA).collect(), lambda t: spark.read.parquet(f"{DATA}/{t}.parquet").count()
    left, right = [r for r in rows if r[2] is None], [r for r in rows if r[0] is None]
    assert left and right and len(rows) - len(right) == size("lineitem") and {r[2] for r in rows if r[2] is not None} == set(range(size("orders")))


@pytest.mark.parametrize("name", ["sort_nulls_last_asc", "sort_nulls_first_desc"])
def test_whole_sorts_show_nulls_and_values(spark, duck, name):
    got = [tuple(r) for r in QUERIES[name](spark, DATA).collect()]
    assert got == duck.execute(ORACLE[name]).fetchall() and len(got) == spark.read.parquet(f"{DATA}/orders.parquet").count()
    assert (got[0][1] is None, got[-1][1] is None) == ((False, True) if "last" in name else (True, False))


@pytest.fixture
def market(spark):
    """Crates of fruit in the bays of a market hall; one bay is empty, and some crates stand in none."""
    crates = [(11, "plum", "stone", 4.5, "east"), (12, "Pear", "pome", 8.0, "west"), (13, "quince", "pome", 2.25, None), (14, "apricot", "stone", 6.0, "east"),
              (15, "fig", None, None, "east"), (16, "medlar", "pome", 3.0, None), (17, "cherry", "stone", 12.5, "west")]
    c = spark.createDataFrame(crates, "crate int, fruit string, kind string, kilos double, bay string")
    b = spark.createDataFrame([("east", 3), ("west", 5), ("north", 7)], "bay string, lamps int")
    return Catalog(spark, tables={"crates": c, "bays": b})


def vals(q):
    return [tuple(r) if len(r) > 1 else r[0] for r in (q.to_df() if hasattr(q, "to_df") else q).collect()]


def test_filters(market):
    q = Query.table(market, "crates").select("crate").order_by("crate")
    assert vals(q.where("kilos", ">=", 6)) == [12, 14, 17]
    assert vals(q.where("fruit", "like", "p%")) == [11] and vals(q.where("fruit", "ilike", "p%")) == [11, 12]
    assert vals(q.where("kind", "=", None)) == []
    assert vals(q.where("bay", "not in", ["east"])) == [12, 17]
    assert vals(q.where("kind", "not in", [])) == [11, 12, 13, 14, 16, 17]
    assert vals(q.where("kilos", "between", (3, 6))) == [11, 14, 16]


def test_truth_table(spark):
    df = spark.createDataFrame([(a, b) for a in (True, False, None) for b in (True, False, None)], "a boolean, b boolean")
    got = df.select("a", "b", P.all_(F.col("a"), F.col("b")).alias("n"), P.any_(F.col("a"), F.col("b")).alias("o"), P.negate(F.col("a")).alias("m")).collect()
    for r in got:
        assert r.n == (False if False in (r.a, r.b) else None if None in (r.a, r.b) else True)
        assert r.o == (True if True in (r.a, r.b) else None if None in (r.a, r.b) else False)
        assert r.m == (None if r.a is None else not r.a)


def test_aggregates(market):
    q = Query.table(market, "crates")
    assert vals(q.where("kilos", "<", 5).select(agg("sum", "kilos", "s"), agg("min", "kilos", "m"))) == [(9.75, 2.25)]
    assert sorted(vals(q.group_by("kind").select("kind", agg("sum", "kilos", "s"))), key=repr) == sorted([("stone", 23.0), ("pome", 13.25), (None, None)], key=repr)
    assert vals(q.where("kilos", ">", 1000).select(agg("count", alias="n"), agg("sum", "kilos", "s"))) == [(0, None)]


def test_joins(market):
    q = Query.table(market, "crates").select("crate", "lamps")
    on = ("crates.bay", "bays.bay")
    inner = [(11, 3), (12, 5), (14, 3), (15, 3), (17, 5)]
    assert sorted(vals(q.join("bays", on))) == inner
    assert set(vals(q.left_join("bays", on))) - set(inner) == {(13, None), (16, None)}
    assert set(vals(q.right_join("bays", on))) - set(inner) == {(None, 7)}
    assert len(vals(q.full_join("bays", on))) == 8
    n = Query.table(market, "crates").join("bays", on).group_by("bays.lamps").select("lamps", agg("count", alias="n"))
    assert sorted(vals(n)) == [(3, 3), (5, 2)]


def test_many_rows_out_come_from_many_tasks(spark):
    sizes = sorted(r["count"] for r in QUERIES["join_null_keys"](spark, DATA).groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) >= 4 and sizes[-1] < sum(sizes) / 2  # one small file is one task
    c = Catalog(spark, DATA)
    rows = lambda kind, many: sorted(map(tuple, Query.table(c, "customer", "c").join("supplier", ("c.c_nationkey", "s.s_nationkey"), kind=kind, alias="s", many=many)
                                         .select("c.c_custkey", "s.s_suppkey").collect()), key=repr)
    for kind in ("inner", "left", "right", "full"):
        assert rows(kind, True) == rows(kind, False)


def test_many_rows_out_take_few_bytes(spark, tmp_path):
    """They come in an order in which values repeat at short distance; a tile's own order, of dupes and nulls too, changes no row."""
    left, right = spark.range(3000).selectExpr("id AS n", "nullif(id % 4, 3) AS k"), spark.range(1200).selectExpr("id AS m", "id % 2 AS k")
    c = Catalog(spark, tables={"l": left.union(left.where("n < 5")), "r": right.union(right.where("m < 5"))})
    rows = lambda many: Query.table(c, "l").left_join("r", ("l.k", "r.k"), many=many).select("n", "m").to_df()
    rows(True).write.parquet(str(tmp_path / "rows"))
    got, want = spark.read.parquet(str(tmp_path / "rows")), rows(False)
    n = got.count()
    assert n == want.count() > 900_000 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert sum(f.stat().st_size for f in (tmp_path / "rows").glob("*.parquet")) < 0.6 * n  # 1.3 bytes a row if a row's matches come one after the other


def test_many_keeps_names_kinds_and_values(spark):
    """Swapped pairs, two pairs, keys of two types, NaN, -0.0, nulls, maps, equal rows, names of any case, columns of one name."""
    a = [(i, (None, 1.0, 0.0, -0.0, float("nan"))[i % 5], ("x", "y", None)[i % 3], {"i": i}) for i in range(90)] + [(None, 1.0, "x", None)] * 3
    b = [(i, (None, 1, 0, 4)[i % 4], ("x", "Y", "y", None)[i // 4 % 4], "w" * (i % 3)) for i in range(60)] + [(None, 1, "x", None)] * 2
    c = Catalog(spark, tables={"a": spark.createDataFrame(a, "id int, k double, s string, m map<string,int>"), "b": spark.createDataFrame(b, "id int, k long, s string, v string")})
    for kind in ("inner", "left", "right"):
        for pairs, items in (([("a.k", "b.k")], ["a.id", "b.id as other"]), ([("b.k", "a.k"), ("a.s", "b.s")], ["M", "v as z", "a.k"]), ([("a.s", "v")], ["b.V"]), ([("a.s", "b.s")], None)):
            q = [Query.table(c, "a").join("b", *pairs, kind=kind, many=many) for many in (True, False)]
            x, y = ((q.select(*items) if items else q.select_all()).to_df() for q in q)
            assert "__rows0" in plan_text(x) and x.dtypes == y.dtypes and sorted(map(repr, x.collect())) == sorted(map(repr, y.collect()))
    few = q[0].where("a.id", "<", 9).select("a.id", "v")
    assert "__rows0" not in plan_text(few.to_df()) and sorted(vals(few), key=repr) == sorted(vals(q[1].where("a.id", "<", 9).select("a.id", "v")), key=repr)


def test_set_operations(spark, market):
    bag = lambda *x: spark.createDataFrame([(v,) for v in x], "x string")
    c = Catalog(spark, tables={"l": bag("q", "p", "q", None, "q", None), "r": bag(None, "q"), "i": spark.createDataFrame([(1,)], "x int")})
    a, b = Query.table(c, "l"), Query.table(c, "r")
    assert sorted(vals(a.intersect(b, all=True)), key=repr) == sorted(["q", None], key=repr)
    assert sorted(vals(a.except_(b, all=True)), key=repr) == sorted([None, "p", "q", "q"], key=repr)
    assert vals(a.except_(b)) == ["p"]
    with pytest.raises(QueryRefused):
        a.union(Query.table(c, "i")).to_df()
    stone = Query.table(market, "crates").where("kind", "=", "stone").select("fruit")
    assert sorted(vals(stone.except_(Query.table(market, "crates").where("kilos", ">", 6).select("fruit")))) == ["apricot", "plum"]
    assert vals(stone.union(stone).order_by("fruit", "desc").limit(2)) == ["plum", "cherry"]


def test_clauses_after_set_operations(market):
    """They hold for the combined rows; none is dropped."""
    q = Query.table(market, "crates")
    both = q.where("kilos", "<", 4).select("crate", "kind").union(q.where("kilos", ">", 7).select("crate", "kind"))
    assert sorted(vals(both)) == [(12, "pome"), (13, "pome"), (16, "pome"), (17, "stone")]
    assert sorted(vals(both.where("crate", ">", 12))) == [(13, "pome"), (16, "pome"), (17, "stone")]
    assert sorted(vals(both.select("kind"))) == ["pome", "pome", "pome", "stone"]
    assert sorted(vals(both.group_by("kind").select("kind", agg("count", alias="n")))) == [("pome", 3), ("stone", 1)]
    assert sorted(vals(both.left_join("crates", ("crates.crate", "c.crate"), alias="c").select("c.fruit"))) == ["Pear", "cherry", "medlar", "quince"]
    assert vals(both.order_by("crate").limit(2).where("crate", "=", 17)) == []
    assert sorted(vals(both.where("crate", ">", 12).union(both.where("crate", "=", 12)))) == sorted(vals(both))


def test_null_order(spark):
    q = Query.table(Catalog(spark, tables={"t": spark.createDataFrame([("a",), (None,), ("b",)], "x string")}), "t")
    assert vals(q.order_by("x")) == ["a", "b", None] and vals(q.order_by("x", "desc")) == [None, "b", "a"]


def test_writes(market):
    s, q = Store(market), Query.table(market, "crates")
    done = s.update("crates", P.comparison("fruit", "=", "fig"), {"kind": "stone", "kilos": 1.5})
    assert done.affected == 1 and vals(done.rows) == [(15, "fig", "stone", 1.5, "east")]
    assert vals(q.where("kind", "=", "stone").select(agg("count", alias="n"))) == [4]
    done = s.insert("crates", [{"crate": 18, "fruit": "sloe"}, {"crate": 19}])
    assert done.affected == 2 and vals(done.rows.select("fruit")) == ["sloe", None] and len(vals(q)) == 9
    with pytest.raises(QueryRefused):
        s.insert("crates", [{"colour": "red"}])
    with pytest.raises(QueryRefused):
        s.delete("crates", None)
    for f in (s.begin, s.commit, s.rollback, s.execute_raw):
        with pytest.raises(QueryRefused):
            f()


def test_delete_hides_rows_from_every_query(spark, market):
    market.register("crates", market.stored("crates").withColumn("status", F.lit("fresh")))
    s, q = Store(market, allow_archiving_delete=True), Query.table(market, "crates")
    done = s.delete("crates", P.comparison("kilos", ">", 5))
    assert done.affected == 3 and vals(done.rows) == []
    assert sorted(vals(q.select("crate"))) == [11, 13, 15, 16] and set(vals(q.select("status"))) == {"fresh"}
    assert "__archived" not in q.to_df().columns and sorted(vals(Query.table(market, "bays").join("crates", ("bays.bay", "crates.bay")).select("crate"))) == [11, 15]
    assert s.delete("crates", P.comparison("kilos", ">", 4)).affected == 1  # those archived before aren't met again
    assert s.update("crates", None, {"kind": "any"}).affected == 3
    s.insert("crates", [{"crate": 20, "kilos": 9.0}])
    assert sorted(vals(q.select("crate"))) == [13, 15, 16, 20]
    with pytest.raises(QueryRefused):
        s.update("crates", None, {"__archived": False})
    assert s.restore("crates", P.comparison("crate", "=", 17)).affected == 1
    assert vals(q.where("crate", "=", 17).select("kind")) == ["stone"]


def test_writes_persist(spark, market, tmp_path):
    folder, again = f"file://{tmp_path}/kept", lambda: Store(Catalog(spark, tables=dict(market.tables)), True, f"file://{tmp_path}/kept").catalog
    s = Store(market, True, folder)
    s.insert("crates", [{"crate": 21}])
    s.insert("crates", [{"crate": 22}])
    assert len(vals(Query.table(market, "crates"))) == len(vals(Query.table(again(), "crates"))) == 9
    s.delete("crates", P.comparison("kilos", ">", 5))
    s.insert("crates", [{"crate": 23, "bay": "east"}])
    s.update("crates", P.comparison("bay", "=", "east"), {"kilos": 1.0})
    want = sorted(vals(Query.table(market, "crates")), key=repr)
    assert len(want) == 7 and sorted(vals(Query.table(again(), "crates")), key=repr) == want
    assert len(vals(Query.table(again(), "bays"))) == 3


def test_refusals(market):
    q = Query.table(market, "crates")
    for f in (lambda: q.where("fruit", "not like", "x").to_df(), lambda: q.where(3, "=", 1), lambda: q.where("fruit", "is", 1).to_df(),
              lambda: q.where("fruit", "in", q).to_df(), lambda: q.where("fruit", "like", 3).to_df()):
        with pytest.raises(UnsupportedWhere):
            f()
    for f in (lambda: q.select(F.lit(1)), lambda: agg("sum", "x"), lambda: agg("median", "x", "m"), lambda: q.having("x"), lambda: q.limit(1.5),
              lambda: q.group_by("kind").select("fruit", agg("count", alias="n")).to_df(), lambda: q.order_by(F.lit(1)),
              lambda: q.join("crates", ("crates.crate", "crates.crate"))):
        with pytest.raises(QueryRefused):
            f()
    with pytest.raises(UnsupportedJoin):
        q.join("bays", ("crates.bay", "bays.bay"), kind="cross").to_df()
    with pytest.raises(UnsupportedJoin):
        q.join("bays").to_df()
    with pytest.raises(UnknownTable, match="bays"):
        Query.table(market, "nothing").to_df()


def test_scan_budget(spark, market):
    """Rows that only a filter beyond the scan's own throws away count, when the query runs."""
    q = Query.table(market, "crates", max_scanned=2)
    assert len(vals(q)) == 7 and q.where("kilos", ">", 5).collect() and q.where("fruit", "like", "p%").collect()
    df = q.where("fruit", "ilike", "%z%").to_df()  # nothing runs yet
    with pytest.raises(Exception, match="crates.*exceeds the scan budget"):
        df.collect()
    with pytest.raises(ScanLimitExceeded, match="2"):
        q.where("fruit", "like", "%zz%").collect()
    assert [r.fruit for r in q.where("kind", "=", "stone").where("fruit", "ilike", "%C%").order_by("fruit").collect()] == ["apricot", "cherry"]
    with pytest.raises(ScanLimitExceeded):
        q.where("fruit", "ilike", "%C%").left_join("bays", ("crates.bay", "bays.bay")).collect()
    assert len(Query.table(market, "crates", max_scanned=5).where("fruit", "ilike", "%c%").collect()) == 3


def test_self_join_and_overrides(spark, market):
    q = Query.table(market, "crates", "a").join("crates", ("a.bay", "b.bay"), alias="b").where_ref("a.crate", "<", "b.crate").select("a.crate as x", "b.crate as y")
    assert sorted(vals(q)) == [(11, 14), (11, 15), (12, 17), (14, 15)]
    c = Catalog(spark, DATA, overrides={"places": "nation"}, system={"places": {"id": "n_nationkey", "updatedAt": "n_regionkey"}})
    assert Query.table(c, "places").select("id", "updatedAt").to_df().count() == 25
    assert Query.table(c, "places").to_df().columns == ["n_nationkey", "n_name", "n_regionkey", "id"]


def test_names_with_dots(spark):
    c = Catalog(spark, tables={"t": spark.createDataFrame([(1, 2), (3, 4)], "`a.b` int, c int")})
    q = Query.table(c, "t")
    assert q.to_df().columns == ["a.b", "c"] and vals(q.where(P.comparison("`a.b`", ">", 1)).select("c")) == [4]


def test_like_patterns():
    assert normalise_like("a\\bc\\") == "abc\\\\" and normalise_like("100\\%") == "100\\%" and normalise_like("\\\\x") == "\\\\x"


def test_coercions(spark):
    c = Catalog(spark, tables={"t": spark.createDataFrame([(True, "10", 10.0), (False, "9", 2.5), (None, "x", None), (None, "", 7.0), (None, None, 8.0)], "b boolean, s string, d double")})
    q = Query.table(c, "t").select("s")
    assert vals(q.where("b", "=", "true")) == ["10"] and vals(q.where("b", "=", 0)) == ["9"]
    assert vals(q.where("s", ">", 9, numeric_text=True)) == ["10"]
    assert sorted(vals(q.where("s", ">", 9))) == ["10", "x"] and sorted(vals(q.where("s", ">", "9"))) == ["10", "x"]
    assert vals(q.where("s", "=", "9.0")) == ["9"] and vals(q.where("s", "in", [10, "x"])) == ["10", "x"] and vals(q.where("s", "not in", ["9.0"])) == ["10", "x", ""]
    assert vals(q.where("d", "=", "10")) == ["10"] and vals(q.where("d", "<", "many")) == ["10", "9", "", None]
    assert vals(q.where("s", "between", ("9", "11"))) == ["10", "9"]
    assert vals(q.where("s", ">", "no number", numeric_text=True)) == []


def test_plans(spark):
    filtered = plan_text(QUERIES["filter_gt_lt"](spark, DATA))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100000.0), LessThan(o_totalprice,200000.0)]" in filtered
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in filtered
    assert "TakeOrderedAndProject" in plan_text(QUERIES["topk"](spark, DATA))
    assert "BroadcastHashJoin" in plan_text(QUERIES["join_inner"](spark, DATA))


def test_stream(spark, market):
    assert [len(b) for b in stream_query(Query.table(market, "crates"), 4)] == [4, 3]
    assert entry.entry(spark).count() == 10
