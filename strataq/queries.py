"""The catalogue of builder queries, one for each operator of the engine."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataq.errors import QueryRefused
from strataq.operators import predicates as P
from strataq.plans.query import Query, agg
from strataq.sources import store
from strataq.sources.catalog import Catalog

CENT = "decimal(18,2)"


def _q(spark, d, name, alias=None, **made):
    return Query.table(Catalog(spark, d, tables={k: f(spark, d) for k, f in made.items()}), name, alias)


def _read(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _nulled(table, key, column, value, alias):
    """``table`` with a column in which ``value`` is NULL."""
    return lambda s, d: _read(s, d, table).select(key, F.nullif(F.col(column), F.lit(value)).alias(alias))


def _cents(table, *columns):
    """Money as decimals, so that a sum doesn't depend on its order."""
    return lambda s, d: _read(s, d, table).withColumns({f"{c}_dec": F.col(c).cast(CENT) for c in columns})


def _plain(table, *items, then=lambda q: q, made=None):
    """A query over one table."""
    def run(spark, d):
        q = _q(spark, d, table, **(made or {}))
        q = then(q)
        return (q.select(*items) if items else q).to_df()
    return run


def _as_double(*names):
    return lambda df: df.withColumns({n: F.col(n).cast("double") for n in names})


def _rounded(**digits):
    return lambda df: df.withColumns({n: F.round(n, k) for n, k in digits.items()})


def _piped(f, *after):
    def run(spark, d):
        df = f(spark, d)
        for a in after:
            df = a(df)
        return df
    return run


def _places(spark, d):
    """nation under another name, with system columns; only ``id`` is part of all columns."""
    c = Catalog(spark, d, overrides={"places": "nation"}, system={"places": {"id": "n_nationkey", "createdAt": "n_regionkey", "updatedAt": "n_regionkey"}})
    return Query.table(c, "places")


def _stored(spark, d, allow=True):
    c = Catalog(spark, d)
    return c, store.Store(c, allow_archiving_delete=allow)


def _deleted(spark, d):
    """customer without those overdrawn, after a delete; a column of the table's own called status keeps its values."""
    c, s = _stored(spark, d)
    c.register("customer", c.stored("customer").withColumn("status", F.col("c_mktsegment")))
    s.delete("customer", P.comparison("c_acctbal", "<", 0))
    return Query.table(c, "customer").select("c_custkey", "status").to_df()


def _affected(spark, d):
    """How many rows an insert, an update and a delete say that they wrote."""
    _, s = _stored(spark, d)
    made = [("insert", s.insert("region", [{"r_regionkey": 98, "r_name": "X"}, {"r_regionkey": 99}]).affected),
            ("update", s.update("customer", P.comparison("c_acctbal", "<", 0), {"c_mktsegment": "OVERDRAWN"}).affected),
            ("delete", s.delete("customer", P.comparison("c_mktsegment", "=", "OVERDRAWN")).affected),
            ("again", s.delete("customer", P.comparison("c_acctbal", "<", 0)).affected)]
    return spark.createDataFrame(made, "write string, affected long")


def _updated(spark, d):
    _, s = _stored(spark, d)
    return s.update("customer", P.comparison("c_acctbal", "<", 0), {"c_mktsegment": "OVERDRAWN"}).rows.select("c_custkey", "c_mktsegment")


#: What the builder refuses, by name.
REFUSED = {
    "aggregate of an expression": lambda q: agg("sum", F.lit(1), "s"),
    "aggregate without alias": lambda q: agg("sum", "o_totalprice"),
    "computed column": lambda q: q.select(F.lit(1)),
    "cross join": lambda q: q.join("customer", ("orders.o_custkey", "customer.c_custkey"), kind="cross").to_df(),
    "delete not allowed": lambda q: store.Store(q.catalog).delete("orders", None),
    "distinct": lambda q: q.distinct(),
    "having": lambda q: q.having("o_orderkey"),
    "like without text": lambda q: q.where("o_orderstatus", "like", 3).to_df(),
    "limit that is no whole number": lambda q: q.limit(1.5),
    "median": lambda q: agg("median", "o_totalprice", "m"),
    "order by expression": lambda q: q.order_by(F.lit(1)),
    "raw SQL": lambda q: store.Store(q.catalog).execute_raw("select 1"),
    "set operation of other types": lambda q: q.select("o_orderkey").union(q.select("o_orderstatus")).to_df(),
    "subquery": lambda q: q.where("o_orderkey", "in", q).to_df(),
    "transaction": lambda q: store.Store(q.catalog).begin(),
    "two tables in FROM": lambda q: Query.table(q.catalog, ["orders", "customer"]),
}


def _refusals(spark, d):
    """Whether each request of REFUSED is refused."""
    def refused(f):
        try:
            f(_q(spark, d, "orders"))
        except QueryRefused:
            return True
        return False

    return spark.createDataFrame([(name, refused(f)) for name, f in REFUSED.items()], "request string, refused boolean")


def _orders_customers(spark, d):
    return _q(spark, d, "orders", "o").join("customer", ("o.o_custkey", "c.c_custkey"), alias="c")


def _docs_labels(kind):
    return lambda s, d: _q(s, d, "documents", "d").join("labels", ("d.doc_id", "l.doc_id"), kind=kind, alias="l")


def _labels_docs(s, d):
    return _q(s, d, "labels", "l").right_join("documents", ("l.doc_id", "d.doc_id"), alias="d")


def _one(s, d, table, column, then=lambda q: q):
    return then(_q(s, d, table)).select(f"{column} as k")


NATIONS = [("customer", "c_nationkey"), ("supplier", "s_nationkey")]
PRIORITY = {"t": _nulled("orders", "o_orderkey", "o_orderpriority", "5-LOW", "p")}
URGENT = {"t": _nulled("orders", "o_orderkey", "o_orderpriority", "1-URGENT", "p")}
FINISHED = {"t": lambda s, d: _read(s, d, "orders").select("o_orderkey", F.expr("case o_orderstatus when 'F' then true when 'O' then false end").alias("done"))}
#: Sizes as text, some with a leading zero, some no numbers, some NULL.
SIZES = {"t": lambda s, d: _read(s, d, "part").select("p_partkey", F.expr(
    "case p_size % 4 when 0 then null when 1 then concat('0', p_size) when 2 then cast(p_size as string) else 'none' end").alias("s"))}
NAMES = {"t": lambda s, d: _read(s, d, "orders").select("o_orderkey", F.expr("case o_orderstatus when 'F' then '' when 'P' then null else o_orderpriority end").alias("n"))}
MARKED = {"t": lambda s, d: _read(s, d, "orders").select("o_orderkey", F.expr(
    "case o_orderstatus when 'F' then translate(o_orderpriority, '-', '_') when 'P' then concat(o_orderpriority, '%') else o_orderpriority end").alias("x"))}
ORDERS_DEC = {"orders_dec": _cents("orders", "o_totalprice")}

QUERIES = {
    "scan_all": _plain("nation"),
    "project_columns": _plain("orders", "o_orderkey", "o_totalprice"),
    "catalog_override": lambda s, d: Query.table(Catalog(s, d, overrides={"places": "nation"}), "places").select("n_name").to_df(),
    "system_columns": lambda s, d: _places(s, d).select("n_name", "id", "createdAt").to_df(),
    "select_all_system": lambda s, d: _places(s, d).to_df(),
    "project_alias": _plain("customer", "c_custkey as customer_id", "c_mktsegment as segment"),
    "filter_eq": _plain("customer", "c_custkey", "c_name", then=lambda q: q.where("c_mktsegment", "=", "BUILDING")),
    "filter_ne": _plain("customer", "c_custkey", then=lambda q: q.where("c_mktsegment", "<>", "BUILDING")),
    "filter_gt_lt": _plain("orders", "o_orderkey", then=lambda q: q.where("o_totalprice", ">", 100000).where("o_totalprice", "<", 200000)),
    "filter_date_range": _plain("orders", "o_orderkey", then=lambda q: q.where("o_orderdate", ">=", "1998-01-01").where("o_orderdate", "<=", "1998-12-31")),
    "filter_col_to_col": _plain("part", "p_partkey", "p_size", then=lambda q: q.where_ref("p_size", ">", "p_partkey")),
    "filter_or_nested": _plain("orders", "o_orderkey", then=lambda q: q.where(P.any_(
        P.all_(P.comparison("o_totalprice", ">", 400000), P.comparison("o_orderstatus", "=", "F")), P.comparison("o_orderpriority", "=", "5-LOW")))),
    "filter_not": _plain("orders", "o_orderkey", then=lambda q: q.where(P.negate(
        P.all_(P.comparison("o_totalprice", ">", 100000), P.comparison("o_orderstatus", "=", "F"))))),
    "filter_not_unknown": _plain("t", "o_orderkey", made=PRIORITY, then=lambda q: q.where(P.negate(P.comparison("p", "=", "3-MEDIUM")))),
    "filter_in": _plain("orders", "o_orderkey", then=lambda q: q.where("o_orderpriority", "in", ["1-URGENT", "2-HIGH"])),
    "filter_not_in": _plain("orders", "o_orderkey", then=lambda q: q.where("o_orderstatus", "not in", ["F", "P"])),
    "filter_in_empty": _plain("orders", "o_orderkey", then=lambda q: q.where("o_orderstatus", "in", [])),
    "filter_not_in_empty": _plain("t", "o_orderkey", made={"t": _nulled("orders", "o_orderkey", "o_orderstatus", "P", "s")}, then=lambda q: q.where("s", "not in", [])),
    "filter_not_in_with_null": _plain("orders", "o_orderkey", then=lambda q: q.where("o_orderstatus", "not in", ["F", None])),
    "filter_between": _plain("orders", "o_orderkey", then=lambda q: q.where("o_totalprice", "between", (100000, 150000))),
    "filter_like_prefix": _plain("part", "p_partkey", "p_name", then=lambda q: q.where("p_name", "like", "red%")),
    "filter_like_underscore": _plain("orders", "o_orderkey", then=lambda q: q.where("o_orderpriority", "like", "_-H%")),
    "filter_like_escape": _plain("t", "o_orderkey", "x", made=MARKED, then=lambda q: q.where(P.any_(P.matches("x", "1\\_U%"), P.matches("x", "%\\%")))),
    "filter_ilike": _plain("customer", "c_custkey", then=lambda q: q.where("c_mktsegment", "ilike", "%build%")),
    "filter_is_empty": _plain("t", "o_orderkey", "n", made=NAMES, then=lambda q: q.where("n", "is", None)),
    "filter_is_not_empty": _plain("t", "o_orderkey", "n", made=NAMES, then=lambda q: q.where("n", "is not", None)),
    "filter_true": _plain("part", "p_partkey", then=lambda q: q.where(P.always_true())),
    "filter_boolean_text": _plain("t", "o_orderkey", made=FINISHED, then=lambda q: q.where("done", "=", "true")),
    "filter_boolean_number": _plain("t", "o_orderkey", made=FINISHED, then=lambda q: q.where("done", "=", 0)),
    "filter_numeric_text": _plain("t", "p_partkey", "s", made=SIZES, then=lambda q: q.where("s", ">", 9)),
    "filter_numeric_text_in": _plain("t", "p_partkey", made=SIZES, then=lambda q: q.where("s", "in", ["07", "none", 12])),
    "filter_number_against_text": _plain("part", "p_partkey", then=lambda q: q.where("p_size", "<", "9").where("p_size", "<>", "many")),
    "scan_budget": lambda s, d: Query.table(Catalog(s, d), "orders", max_scanned=0).where("o_orderstatus", "=", "F").select("o_orderkey").to_df(),
    "topk": _plain("orders", "o_orderkey", "o_totalprice", then=lambda q: q.where("o_orderstatus", "=", "F").where("o_totalprice", ">", 40)
                   .order_by("o_totalprice", "desc").order_by("o_orderkey").limit(10)),
    "limit_offset": _plain("customer", "c_custkey", "c_acctbal", then=lambda q: q.order_by("c_acctbal").order_by("c_custkey").limit(20).offset(30)),
    "sort_nulls_last_asc": _plain("t", "o_orderkey", "p", made=URGENT, then=lambda q: q.order_by("p").order_by("o_orderkey")),
    "sort_nulls_first_desc": _plain("t", "o_orderkey", "p", made=URGENT, then=lambda q: q.order_by("p", "desc").order_by("o_orderkey")),
    "agg_count_star": _plain("orders", agg("count", alias="n"), then=lambda q: q.where("o_orderstatus", "=", "F")),
    "agg_count_col_vs_star": _plain("t", agg("count", alias="n_rows"), agg("count", "p", "n_vals"), made=PRIORITY),
    "agg_count_distinct": _plain("orders", agg("count", "o_custkey", "n", distinct=True)),
    "agg_sum_avg_min_max": _piped(_plain("orders_dec", agg("sum", "o_totalprice_dec", "s"), agg("avg", "o_totalprice", "a"), agg("min", "o_totalprice", "lo"),
                                         agg("max", "o_totalprice", "hi"), made=ORDERS_DEC), _as_double("s"), _rounded(a=4)),
    "agg_sum_distinct": _piped(_plain("part", agg("sum", "p_size", "s", distinct=True), agg("avg", "p_size", "a", distinct=True)), _rounded(a=6)),
    "agg_min_max_text": _plain("customer", agg("min", "c_mktsegment", "lo"), agg("max", "c_mktsegment", "hi")),
    "agg_empty": _plain("orders", agg("count", alias="n"), agg("sum", "o_totalprice", "s"), agg("avg", "o_totalprice", "a"), agg("min", "o_totalprice", "lo"),
                        then=lambda q: q.where("o_totalprice", "<", 0)),
    "group_one": _piped(_plain("orders_dec", "o_orderstatus", agg("count", alias="n"), agg("sum", "o_totalprice_dec", "total"), made=ORDERS_DEC,
                               then=lambda q: q.group_by("o_orderstatus")), _as_double("total")),
    "group_many": _piped(_plain("li", "l_returnflag", "l_linestatus", agg("count", alias="n"), agg("sum", "l_quantity_dec", "qty"),
                                made={"li": _cents("lineitem", "l_quantity")}, then=lambda q: q.group_by("l_returnflag", "l_linestatus")), _as_double("qty")),
    "group_null_bucket": _plain("t", "p", agg("count", alias="n"), made=PRIORITY, then=lambda q: q.group_by("p")),
    "group_keys_only": _plain("part", "p_type", then=lambda q: q.group_by("p_type")),
    "group_order_limit": _plain("customer", "c_nationkey", agg("count", alias="n"), then=lambda q: q.group_by("c_nationkey").order_by("n", "desc").order_by("c_nationkey").limit(5)),
    "group_empty": _plain("orders", "o_orderstatus", agg("count", alias="n"), then=lambda q: q.where("o_totalprice", "<", 0).group_by("o_orderstatus")),
    "join_inner": lambda s, d: _orders_customers(s, d).select("o.o_orderkey", "c.c_name").to_df(),
    "join_left": lambda s, d: _docs_labels("left")(s, d).select("d.doc_id", "l.quality").to_df(),
    "join_right": lambda s, d: _labels_docs(s, d).select("l.quality", "d.doc_id").to_df(),
    "join_full": lambda s, d: _q(s, d, "lineitem", "l").full_join("orders", ("l.l_orderkey", "o.o_orderkey"), ("l.l_shipdate", "o.o_orderdate"), alias="o")
    .select("l.l_orderkey", "l.l_linenumber", "o.o_orderkey").to_df(),
    "join_dup_keys": lambda s, d: _q(s, d, "nation", "n").join("supplier", ("n.n_nationkey", "s.s_nationkey"), alias="s").select("n.n_name", "s.s_suppkey").to_df(),
    "join_null_keys": lambda s, d: _q(s, d, "a", a=_nulled("customer", "c_custkey", "c_nationkey", 3, "k"), b=_nulled("supplier", "s_suppkey", "s_nationkey", 3, "k"))
    .left_join("b", ("a.k", "b.k"), many=True).select("a.c_custkey", "b.s_suppkey").to_df(),
    "join_composite": lambda s, d: _q(s, d, "lineitem", "l").join("orders", ("l.l_orderkey", "o.o_orderkey"), ("l.l_shipdate", "o.o_orderdate"), alias="o")
    .select("l.l_orderkey", "o.o_orderdate").to_df(),
    "join_chain": lambda s, d: _q(s, d, "region", "r").join("nation", ("r.r_regionkey", "n.n_regionkey"), alias="n")
    .join("supplier", ("n.n_nationkey", "s.s_nationkey"), alias="s").select("r.r_name", "n.n_name", "s.s_suppkey").to_df(),
    "join_where_driving": lambda s, d: _orders_customers(s, d).where("o.o_orderstatus", "=", "F").select("o.o_orderkey", "c.c_name").to_df(),
    "join_where_spanning": lambda s, d: _orders_customers(s, d).where("o.o_orderstatus", "=", "F").where("c.c_mktsegment", "=", "BUILDING")
    .select("o.o_orderkey", "c.c_name").to_df(),
    "join_left_anti_idiom": lambda s, d: _docs_labels("left")(s, d).where("l.doc_id", "is", None).select("d.doc_id").to_df(),
    "join_right_where_is_null": lambda s, d: _labels_docs(s, d).where("l.quality", "is", None).select("d.doc_id").to_df(),
    "join_order_limit": lambda s, d: _orders_customers(s, d).select("o.o_orderkey", "c.c_name", "o.o_totalprice")
    .order_by("o_totalprice", "desc").order_by("o_orderkey").limit(10).to_df(),
    "join_select_all": lambda s, d: _q(s, d, "region", "r").join("nation", ("r.r_regionkey", "n.n_regionkey"), alias="n").to_df(),
    "join_group": lambda s, d: _orders_customers(s, d).group_by("c.c_mktsegment").select("c_mktsegment", agg("count", alias="n"), agg("max", "o.o_totalprice", "most")).to_df(),
    "join_offset": lambda s, d: _orders_customers(s, d).select("o.o_orderkey", "c.c_name").order_by("o_orderkey").limit(20).offset(30).to_df(),
    "group_offset": _plain("customer", "c_nationkey", agg("count", alias="n"), then=lambda q: q.group_by("c_nationkey").order_by("n", "desc").order_by("c_nationkey").limit(5).offset(7)),
    "union_distinct": lambda s, d: _one(s, d, *NATIONS[0]).union(_one(s, d, *NATIONS[1])).to_df(),
    "union_all": lambda s, d: _one(s, d, *NATIONS[0]).union(_one(s, d, *NATIONS[1]), all=True).to_df(),
    "intersect_distinct": lambda s, d: _one(s, d, "orders", "o_custkey").intersect(_one(s, d, "customer", "c_custkey", lambda q: q.where("c_acctbal", ">", 5000))).to_df(),
    "intersect_all": lambda s, d: _one(s, d, *NATIONS[0]).intersect(_one(s, d, *NATIONS[1]), all=True).to_df(),
    "except_distinct": lambda s, d: _one(s, d, "customer", "c_custkey").except_(_one(s, d, "orders", "o_custkey", lambda q: q.where("o_totalprice", ">", 400000))).to_df(),
    "except_all": lambda s, d: _one(s, d, "orders", "o_custkey").except_(_one(s, d, "customer", "c_custkey"), all=True).to_df(),
    "setop_null_match": lambda s, d: _q(s, d, "a", a=_nulled("customer", "c_custkey", "c_nationkey", 3, "k")).select("k")
    .intersect(_q(s, d, "b", b=_nulled("supplier", "s_suppkey", "s_nationkey", 3, "k")).select("k")).to_df(),
    "setop_left_fold": lambda s, d: _one(s, d, "nation", "n_nationkey").union(_one(s, d, "region", "r_regionkey"), all=True)
    .intersect(_one(s, d, "customer", "c_nationkey", lambda q: q.where("c_nationkey", "<", 10))).to_df(),
    "setop_order_limit": lambda s, d: _one(s, d, "orders", "o_custkey", lambda q: q.where("o_totalprice", ">", 400000))
    .union(_one(s, d, "customer", "c_custkey", lambda q: q.where("c_acctbal", "<", 0))).order_by("k", "desc").limit(10).to_df(),
    "setop_offset": lambda s, d: _one(s, d, *NATIONS[0]).union(_one(s, d, *NATIONS[1])).order_by("k").limit(6).offset(9).to_df(),
    "setop_then_where": lambda s, d: _one(s, d, "orders", "o_custkey").union(_one(s, d, "customer", "c_custkey")).where("k", ">", 50).where("k", "<=", 900).to_df(),
    "setop_then_group": lambda s, d: _one(s, d, *NATIONS[0]).union(_one(s, d, *NATIONS[1]), all=True).group_by("k").select("k", agg("count", alias="n")).to_df(),
    "setop_then_join": lambda s, d: _one(s, d, *NATIONS[0]).union(_one(s, d, *NATIONS[1])).join("nation", ("customer.k", "n.n_nationkey"), alias="n").select("customer.k", "n.n_name").to_df(),
    "setop_limit_then_where": lambda s, d: _one(s, d, "orders", "o_custkey").union(_one(s, d, "customer", "c_custkey")).order_by("k").limit(40).where("k", ">", 20).to_df(),
    "refusals": _refusals,
    "write_affected": _affected,
    "write_updated_rows": _updated,
    "write_delete": _deleted,
    "write_insert": lambda s, d: store.insert(_read(s, d, "region"), [{"r_regionkey": 99, "r_name": "NOWHERE"}]),
    "write_update": lambda s, d: store.update(_read(s, d, "customer"), P.comparison("c_acctbal", "<", 0), {"c_mktsegment": "OVERDRAWN"}).select("c_custkey", "c_mktsegment"),
    "write_archive": lambda s, d: store.live(store.archive(_read(s, d, "customer"), P.comparison("c_acctbal", "<", 0))).select("c_custkey"),
}
