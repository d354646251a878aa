"""Graph views over the driver's TPC-H-like tables (FIXTURES.md section 4).

The modulo rules below shape the data, they do not sample it: every row of
every base table is used. ``p_partkey % 50 = 0`` gives a device a supplier's
name (a cross-label conflict), ``o_orderkey % 97 = 0`` makes a call end at a
name that does not exist (a dangling edge), and the ``c_custkey`` rules set
flags and statuses.

``mobile`` <- customer, ``device`` <- part (1 in 50 parts takes a supplier
name, so names conflict with wifi), ``wifi`` <- supplier, ``call`` <- orders
(repeats, self-loops, a dangling 'missing' end, null mgm), ``use`` /
``use_wifi`` <- orders x lineitem x customer x device/wifi, ``has`` <- the
same restricted to returned lines. The same definitions are written as SQL
CTEs in ``plans.oracle_base`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import base_table
from ..schema import DEVICE, MOBILE, WIFI
from ..session import freeze


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return base_table(spark, sf_dir, name)


def mobile(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    cols = [
        F.col("c_name").alias("name"),
        F.col("c_name").alias("nm_pass"),
        F.sha1("c_name").alias("nm_sha1"),
        F.when(F.col("c_acctbal") > 0, F.lit("true")).alias("is_register"),
        F.when(F.col("c_acctbal") < 0, F.lit("true")).alias("is_risk"),
        F.lit(None).cast("string").alias("is_internal"),
        F.when(F.col("c_custkey") % 10 == 0, F.lit("true")).alias("is_service"),
        F.col("c_mktsegment").alias("merchant_name"),
        F.nullif(F.col("c_nationkey") % 5, F.lit(0)).cast("int").alias("status"),
        F.when(F.col("c_custkey") % 4 < 2, F.col("c_custkey") % 4).cast("int").alias("suspect_risk"),
        F.nullif(F.col("c_custkey") % 3, F.lit(0)).cast("int").alias("overdue_status"),
    ]
    if with_key:
        cols.append(F.col("c_custkey").alias("k"))
    return c.select(*cols)


def device(spark: SparkSession, sf_dir: str, with_key: bool = True) -> DataFrame:
    p = _t(spark, sf_dir, "part")
    name = (F.when(F.col("p_partkey") % 50 == 0,
                   F.concat(F.lit("Supplier#"),
                            F.lpad(F.floor(F.col("p_partkey") / 50).cast("bigint").cast("string"), 9, "0")))
            .otherwise(F.concat(F.lit("FP"), F.col("p_partkey").cast("string"))))
    cols = [name.alias("name"),
            F.when(F.col("p_size") > 40, F.lit("true")).alias("is_exception"),
            F.when(F.col("p_size") < 5, F.lit("true")).alias("is_white")]
    if with_key:
        cols.append(F.col("p_partkey").alias("k"))
    return p.select(*cols)


def wifi(spark: SparkSession, sf_dir: str, with_key: bool = True) -> DataFrame:
    s = _t(spark, sf_dir, "supplier")
    cols = [F.col("s_name").alias("name"),
            F.when(F.col("s_acctbal") < 0, F.lit("true")).alias("is_exception"),
            F.lit(None).cast("string").alias("is_white")]
    if with_key:
        cols.append(F.col("s_suppkey").alias("k"))
    return s.select(*cols)


def _call_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    cust = _t(spark, sf_dir, "customer")
    c = cust.select("c_custkey", "c_name")
    n_cust = cust.select(F.count(F.lit(1))).scalar()
    target = (F.col("o_custkey") * 31 + F.col("o_orderkey") * 17) % n_cust
    mgm = F.when(F.col("o_orderstatus") == "F", F.lit(1)).when(F.col("o_orderstatus") == "P", F.lit(0))
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("c_name").alias("start_name"), target.alias("target"), mgm.alias("mgm"),
                    F.col("o_orderkey").alias("ord")))


def _customer_name(idx) -> F.Column:
    return F.concat(F.lit("Customer#"), F.lpad(idx.cast("string"), 9, "0"))


def call(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CALL edges by name: start_name, end_name, mgm."""
    b = _call_base(spark, sf_dir)
    end = F.when(F.col("ord") % 97 == 0, F.lit("missing")).otherwise(_customer_name(F.col("target")))
    return b.select("start_name", end.alias("end_name"), "mgm")


def call_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CALL rows for the edge upserts: (start_name, label, end_name, mgm, ord), ord = order key.

    A customer calls one of three others, picked by the order key, so pairs repeat as soon as a customer has
    a few orders, and the number of pairs grows with the customers. Every 97th order ends at 'missing'.
    """
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    cust = _t(spark, sf_dir, "customer")
    n_cust = cust.select(F.count(F.lit(1))).scalar()
    target = (F.col("o_custkey") * 31 + F.col("o_orderkey") % 3) % n_cust + 1
    end = F.when(F.col("o_orderkey") % 97 == 0, F.lit("missing")).otherwise(_customer_name(target))
    mgm = F.when(F.col("o_orderstatus") == "F", F.lit(1)).when(F.col("o_orderstatus") == "P", F.lit(0))
    return (o.join(cust.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("c_name").alias("start_name"), F.lit("CALL").alias("label"), end.alias("end_name"),
                    mgm.alias("mgm"), F.col("o_orderkey").alias("ord")))


def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices of all three labels for the upserts: (label, name, k, merchant_name, status)."""
    m = mobile(spark, sf_dir, with_key=True).select(F.lit(MOBILE).alias("label"), "name", "k", "merchant_name", "status")
    d = device(spark, sf_dir).select(F.lit(DEVICE).alias("label"), "name", "k", F.coalesce("is_exception", F.lit("plain")
                                     ).alias("merchant_name"), (F.col("k") % 4).cast("int").alias("status"))
    w = wifi(spark, sf_dir).select(F.lit(WIFI).alias("label"), "name", "k", F.col("is_exception").alias("merchant_name"),
                                   F.lit(None).cast("int").alias("status"))
    return m.unionByName(d).unionByName(w)


def upsert_state(rows: DataFrame) -> DataFrame:
    """The stored part of ``upsert_rows``; each row is in the state, the delta, or both."""
    return rows.where(F.col("k") % 3 != 0).select("label", "name", "merchant_name", "status")


def upsert_delta(rows: DataFrame) -> DataFrame:
    """(label, name, merchant_name, status, ord): new keys and stored ones; every fifth key comes twice."""
    came = rows.where((F.col("k") % 3 == 0) | (F.col("k") % 2 == 0))
    once = came.select("label", "name", F.when(F.col("k") % 4 == 0, F.concat("merchant_name", F.lit("2"))).alias("merchant_name"),
                       (F.col("k") % 7 - 1).cast("int").alias("status"), (2 * F.col("k")).alias("ord"))
    again = came.where(F.col("k") % 5 == 0).select(
        "label", "name", F.when(F.col("k") % 2 == 0, F.concat(F.coalesce("merchant_name", F.lit("x")), F.lit("3"))).alias("merchant_name"),
        (F.col("k") % 6 - 2).cast("int").alias("status"), (2 * F.col("k") + 1).alias("ord"))
    return once.unionByName(again)


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_name, l_partkey, l_suppkey, l_returnflag): the lines, met by orders that have their customer already.

    So the lines, the largest table, are shuffled by one key only, however large the customers are.
    """
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    buyers = o.join(c, F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", "c_name")
    return (li.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
            .select("c_name", "l_partkey", "l_suppkey", "l_returnflag"))


def _distinct_edges(edges: DataFrame) -> DataFrame:
    """Distinct (start_name, end_name), met by start_name: a join on it, as in the resolution, needs no shuffle of its own."""
    return edges.repartition("start_name").distinct()


def use(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """USE edges by name; ``lines``: ``_order_lines`` if they are there already (so for the two below)."""
    d = device(spark, sf_dir).select(F.col("name").alias("d_name"), F.col("k"))
    j = (lines or _order_lines(spark, sf_dir)).join(d, F.col("k") == F.col("l_partkey"))
    return _distinct_edges(j.select(F.col("c_name").alias("start_name"), F.col("d_name").alias("end_name")))


def use_wifi(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    w = wifi(spark, sf_dir).select(F.col("name").alias("w_name"), F.col("k"))
    j = (lines or _order_lines(spark, sf_dir)).join(w, F.col("k") == F.col("l_suppkey"))
    return _distinct_edges(j.select(F.col("c_name").alias("start_name"), F.col("w_name").alias("end_name")))


def has(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    d = device(spark, sf_dir).select(F.col("name").alias("d_name"), F.col("k"))
    returned = (lines or _order_lines(spark, sf_dir)).where(F.col("l_returnflag") == "R")
    j = returned.join(d, F.col("k") == F.col("l_partkey"))
    return _distinct_edges(j.select(F.col("d_name").alias("start_name"), F.col("c_name").alias("end_name")))


def staged_vertices(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three staged vertex tables, before conflict removal."""
    return {DEVICE: device(spark, sf_dir, with_key=False), WIFI: wifi(spark, sf_dir, with_key=False),
            MOBILE: mobile(spark, sf_dir)}


def staged_edges(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four staged edge tables. Three are made of the order lines, which are joined once and stored for them."""
    lines = freeze(_order_lines(spark, sf_dir), "order-lines")
    return {"CALL": call(spark, sf_dir), "HAS": has(spark, sf_dir, lines), "USE": use(spark, sf_dir, lines),
            "USE_WIFI": use_wifi(spark, sf_dir, lines)}
