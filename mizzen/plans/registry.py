"""Registered queries over the star schema, each beside its SQL for DuckDB.

A query takes (spark, sf_dir) and reads the tables it needs as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import coercion as co
from ..functions import numbers as nu
from ..functions import texts as tx
from ..operators import changes as ch
from ..operators import relational as re_
from ..operators import schema as sc
from ..sources import archive, scratch

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def keep(f: Query) -> Query:
        _QUERIES[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return keep


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Joins


@query("""SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON c_custkey = o_custkey
WHERE c_mktsegment = 'BUILDING' GROUP BY o_orderstatus ORDER BY n DESC LIMIT 10""")
def join_group_top(s, d):
    c = _t(s, d, "customer")
    c = c.where(co.compare(c, "c_mktsegment", "=", "BUILDING")).select("c_custkey")
    o = _t(s, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    out = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return re_.page(out, ["-n", "o_orderstatus"], 10)


@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def join_left(s, d):
    j = _t(s, d, "customer").join(_t(s, d, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("SELECT n_name, count(s_suppkey) AS n FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")
def join_right(s, d):
    j = _t(s, d, "supplier").join(_t(s, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "right")
    return j.groupBy("n_name").agg(F.count("s_suppkey").alias("n"))


@query("SELECT r_name, n_name FROM region CROSS JOIN nation WHERE r_regionkey < n_regionkey")
def join_theta(s, d):
    return _t(s, d, "region").join(_t(s, d, "nation"), F.col("r_regionkey") < F.col("n_regionkey")).select("r_name", "n_name")


@query("SELECT l_orderkey, count(*) AS n, min(l_shipdate) AS first_ship, any_value(o_orderdate) AS o_orderdate FROM (SELECT o_orderkey AS l_orderkey, o_orderdate FROM orders) JOIN lineitem USING (l_orderkey) GROUP BY l_orderkey")
def join_using(s, d):
    o = _t(s, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = o.join(_t(s, d, "lineitem"), ["l_orderkey"])
    return re_.group_by_key(j, ["l_orderkey"], [F.count(F.lit(1)).alias("n"), F.min("l_shipdate").alias("first_ship")], ["o_orderdate"])


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000) AND c_acctbal > 0")
def semi_exists(s, d):
    rich = _t(s, d, "orders").where("o_totalprice > 100000")
    return re_.in_rows(_t(s, d, "customer").where("c_acctbal > 0"), "c_custkey", rich, "o_custkey").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def anti_not_in(s, d):
    rich = _t(s, d, "orders").where("o_totalprice > 300000")
    return re_.not_in_rows(_t(s, d, "customer"), "c_custkey", rich, "o_custkey").select("c_custkey")


@query("""SELECT 'null among them' AS kind, c_custkey FROM customer WHERE c_custkey NOT IN (SELECT nullif(o_custkey, 4) FROM orders WHERE o_totalprice > 300000 UNION ALL SELECT NULL)
UNION ALL SELECT 'null asked', c_custkey FROM (SELECT nullif(c_custkey, 2) AS c_custkey FROM customer) WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
UNION ALL SELECT 'none', c_custkey FROM (SELECT nullif(c_custkey, 2) AS c_custkey FROM customer) WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice < 0)""")
def anti_not_in_null(s, d):
    c, o = _t(s, d, "customer").select("c_custkey"), _t(s, d, "orders")
    rich, asked = o.where("o_totalprice > 300000"), c.select(F.nullif("c_custkey", F.lit(2)).alias("c_custkey"))
    some = rich.select(F.nullif("o_custkey", F.lit(4)).alias("o_custkey")).unionByName(o.agg(F.lit(None).cast("bigint").alias("o_custkey")))
    found = {"null among them": (c, some), "null asked": (asked, rich), "none": (asked, o.where("o_totalprice < 0"))}
    return re_.union_all(*[re_.not_in_rows(x, "c_custkey", y, "o_custkey").select(F.lit(k).alias("kind"), "c_custkey") for k, (x, y) in found.items()])


@query("""SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)""")
def scalar_subquery(s, d):
    o = _t(s, d, "orders")
    mean = o.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("mean"))
    return o.join(mean, "o_custkey").where("o_totalprice > mean").select("o_orderkey")


@query("SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey")
def self_join(s, d):
    t = _t(s, d, "supplier")
    a, b = t.alias("a"), t.alias("b")
    return a.join(b, (F.col("a.s_nationkey") == F.col("b.s_nationkey")) & (F.col("a.s_suppkey") < F.col("b.s_suppkey"))).select(F.col("a.s_suppkey").alias("a"), F.col("b.s_suppkey").alias("b"))


# Predicates


@query("""SELECT p_partkey, coalesce(try_cast(nullif(regexp_extract(p_brand, '[0-9]+'), '') AS DOUBLE), 0) AS brand_no, p_size <> 0 AS sized FROM part
WHERE p_size BETWEEN 5 AND 30 AND p_size IN (5, 7, 11, 13, 29)""")
def numeric_prefix(s, d):
    p = _t(s, d, "part")
    tail = F.regexp_replace("p_brand", r"^\D*", "")
    return p.where(co.between(p, "p_size", 5, 30) & co.within(p, "p_size", [5, 7, "11", "13x", 29.0])).select("p_partkey", co.number_of(tail).alias("brand_no"), co.truth(F.col("p_size"), co.kind_of(p, "p_size")).alias("sized"))


@query("SELECT count(*) AS n FROM part WHERE regexp_matches(p_name, '^[A-Z]') OR p_name ILIKE '%a%'")
def text_search(s, d):
    return _t(s, d, "part").where(F.col("p_name").rlike("^[A-Z]") | co.like(F.col("p_name"), "%A%")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, p_type FROM part WHERE p_type LIKE '%S%' AND encode(p_name) > encode('m')")
def binary_compare(s, d):
    return _t(s, d, "part").where(co.like(F.col("p_type"), "%S%", binary=True) & (co.as_bytes(F.col("p_name")) > co.as_bytes(F.lit("m")))).select("p_partkey", "p_type")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= '1995-01-01' AND o_orderdate < '1995-03-01' AND o_orderstatus IN ('F', 'O')")
def date_range(s, d):
    o = _t(s, d, "orders")
    return o.where(co.compare(o, "o_orderdate", ">=", "1995-01-01") & co.compare(o, "o_orderdate", "<", "1995-03-01") & co.within(o, "o_orderstatus", ["F", "O"])).select("o_orderkey")


@query("""SELECT event_id, (value > 50) <> (user_id % 2 = 1) AS either, coalesce(value > 50, false) AS big, value IS NOT DISTINCT FROM NULL AS missing,
CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 ELSE 0 END AS place FROM events""")
def logic(s, d):
    e = _t(s, d, "events")
    big = co.truth(co.compare(e, "value", ">", 50), co.T.BooleanType())
    return e.select(
        "event_id",
        co.xor(e, big, nu.modulo(e, "user_id", 2)).alias("either"),
        co.is_true(big, co.T.BooleanType()).alias("big"),
        co.compare(e, "value", "<=>", None).alias("missing"),
        co.field(e, "event_type", "click", "view", "purchase").alias("place"),
    )


# Expressions


@query("""SELECT l_orderkey, l_linenumber, l_quantity / nullif(l_linenumber - 1, 0) AS ratio, (l_orderkey % nullif(l_linenumber - 1, 0))::DOUBLE AS rest,
trunc(l_extendedprice / nullif(l_linenumber - 1, 0))::DOUBLE AS whole, (l_orderkey | l_linenumber) AS bits, (l_orderkey & 7) AS low, xor(l_orderkey, 5) AS flipped, round(l_extendedprice)::BIGINT AS price FROM lineitem""")
def arithmetic(s, d):
    c = F.col
    less = c("l_linenumber") - 1
    t = _t(s, d, "lineitem")
    return t.select(
        "l_orderkey", "l_linenumber", nu.divide(t, "l_quantity", less).alias("ratio"), nu.modulo(t, "l_orderkey", less.cast("bigint")).cast("double").alias("rest"), nu.int_divide(t, "l_extendedprice", less).cast("double").alias("whole"),
        nu.bits_or(t, "l_orderkey", "l_linenumber").alias("bits"), nu.bits_and(t, "l_orderkey", 7).alias("low"), nu.bits_xor(t, "l_orderkey", 5).alias("flipped"), nu.signed(t, "l_extendedprice").alias("price"),
    )


@query("""SELECT doc_id, strlen(text) AS bytes, length(text) AS chars, md5(text) AS digest, left(text, 10) AS head, right(text, 5) AS tail, substring(text, 3, 4) AS mid,
CASE WHEN length(text) >= 3 THEN right(text, 3) ELSE '' END AS back, concat_ws('-', lang, NULL, source) AS tag, upper(lang) || ':' || source AS label, coalesce(lang, '?') AS lang2, nullif(lang, 'en') AS other, greatest(lang, source) AS high, least(lang, source) AS low,
reverse(source) AS back_source, replace(source, 'src', 'S') AS short, trim('  ' || lang || ' ') AS trimmed, source || ' ' AS left_trimmed, ' ' || source AS right_trimmed, lower(source) AS small FROM documents""")
def text_functions(s, d):
    c, t = F.col, _t(s, d, "documents")
    return t.select(
        "doc_id", F.octet_length("text").cast("bigint").alias("bytes"), F.char_length("text").cast("bigint").alias("chars"), F.md5("text").alias("digest"), F.left(c("text"), F.lit(10)).alias("head"), F.right(c("text"), F.lit(5)).alias("tail"), tx.substring(c("text"), 3, 4).alias("mid"), tx.substring(c("text"), -3).alias("back"),
        F.concat_ws("-", "lang", F.lit(None), "source").alias("tag"), tx.concat(t, F.upper("lang"), F.lit(":"), "source").alias("label"), F.coalesce("lang", F.lit("?")).alias("lang2"), F.nullif(c("lang"), F.lit("en")).alias("other"),
        F.greatest("lang", "source").alias("high"), F.least("lang", "source").alias("low"), F.reverse("source").alias("back_source"), F.replace(c("source"), F.lit("src"), F.lit("S")).alias("short"), F.trim(tx.concat(t, F.lit("  "), "lang", F.lit(" "))).alias("trimmed"),
        F.ltrim(F.concat(F.lit(" "), "source", F.lit(" "))).alias("left_trimmed"), F.rtrim(F.concat(F.lit(" "), "source", F.lit(" "))).alias("right_trimmed"), F.lower(F.upper("source")).alias("small"),
    )


@query("""SELECT o_orderkey, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, day(o_orderdate)::INT AS d, dayofyear(o_orderdate)::INT AS doy, (dayofweek(o_orderdate) + 1)::INT AS dow, (isodow(o_orderdate) - 1)::INT AS wd,
strftime(o_orderdate, '%Y/%m/%d %H:%M:%S') AS text, epoch(o_orderdate)::DOUBLE AS unix FROM orders""")
def calendar_parts(s, d):
    c = F.col("o_orderdate")
    return _t(s, d, "orders").select("o_orderkey", cal.year(c).alias("y"), F.month(c).alias("m"), F.dayofmonth(c).alias("d"), cal.day_of_year(c).alias("doy"), cal.day_of_week(c).alias("dow"), cal.weekday(c).alias("wd"), cal.date_format(c, "%Y/%m/%d %H:%i:%s").alias("text"), cal.unix_timestamp(c).alias("unix"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%U')::INT AS w0, week(o_orderdate)::INT AS w3, strftime(o_orderdate, '%W')::INT AS w5,
CASE WHEN month(o_orderdate) = 1 AND week(o_orderdate) > 50 THEN 0 WHEN month(o_orderdate) = 12 AND week(o_orderdate) = 1 THEN 53 ELSE week(o_orderdate) END::INT AS w1 FROM orders""")
def calendar_weeks(s, d):
    c = F.col("o_orderdate")
    return _t(s, d, "orders").select("o_orderkey", *[cal.week(c, m).alias(f"w{m}") for m in (0, 3, 5, 1)])


@query("""SELECT event_id, ts + INTERVAL 90 SECOND AS later, ts - INTERVAL 3 MONTH AS before, ts + INTERVAL 2 WEEK AS weeks, ts + INTERVAL 500000 MICROSECOND AS half, ts + INTERVAL 6 MONTH AS quarters FROM events""")
def calendar_intervals(s, d):
    c, n = F.col("ts"), F.lit
    return _t(s, d, "events").select("event_id", cal.add(c, n(1.5), "minute").alias("later"), cal.subtract(c, n(3), "month").alias("before"), cal.add(c, n(2), "week").alias("weeks"), cal.add(c, n(500000), "microsecond").alias("half"), cal.add(c, n(2), "quarter").alias("quarters"))


# Aggregates


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(avg(l_extendedprice), 4) AS avg_price, min(l_discount) AS low, max(l_tax) AS high, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers,
round(stddev_pop(l_quantity), 6) AS std_qty, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_quantity), 4) AS variance, round(var_samp(l_quantity), 4) AS vs FROM lineitem WHERE l_shipdate <= '1998-09-02' GROUP BY ALL""")
def aggregates(s, d):
    t = _t(s, d, "lineitem")
    q = F.col("l_quantity")
    return t.where(co.compare(t, "l_shipdate", "<=", "1998-09-02")).groupBy("l_returnflag", "l_linestatus").agg(
        nu.total(t, q).alias("sum_qty"), F.round(nu.mean(t, "l_extendedprice"), 4).alias("avg_price"), F.min("l_discount").alias("low"), F.max("l_tax").alias("high"), F.count(F.lit(1)).alias("n"), F.countDistinct("l_suppkey").alias("suppliers"),
        F.round(F.stddev_pop(q), 6).alias("std_qty"), F.round(F.stddev_samp(q), 6).alias("sd"), F.round(F.var_pop(q), 4).alias("variance"), F.round(F.var_samp(q), 4).alias("vs"),
    )


@query("SELECT r_name, string_agg(n_name, '; ' ORDER BY n_name) AS nations, string_agg(DISTINCT left(n_name, 1), ',' ORDER BY left(n_name, 1) DESC) AS initials FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def group_concat(s, d):
    j = _t(s, d, "region").join(_t(s, d, "nation"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name").agg(tx.group_concat(F.col("n_name"), "; ").alias("nations"), tx.group_concat(F.left("n_name", F.lit(1)), distinct=True, descending=True).alias("initials"))


@query("SELECT o_custkey, any_value(c_name) AS c_name, sum(o_totalprice) AS total FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey HAVING count(*) > 12")
def having_key(s, d):
    j = _t(s, d, "orders").join(_t(s, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return re_.group_by_key(j, ["o_custkey"], [F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n")], ["c_name"]).where("n > 12").drop("n")


@query("SELECT count(*) AS n, sum(o_totalprice) AS total FROM orders")
def global_aggregate(s, d):
    return _t(s, d, "orders").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))


# Sort, limit, distinct, union


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20 OFFSET 5")
def page(s, d):
    return re_.page(_t(s, d, "orders").select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 20, 5)


@query("SELECT DISTINCT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month FROM orders")
def distinct_calendar(s, d):
    return re_.distinct_calendar(_t(s, d, "orders"), "o_orderdate")


@query("SELECT DISTINCT c_custkey, c_mktsegment FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F'")
def distinct_by_hidden_key(s, d):
    j = _t(s, d, "customer").join(_t(s, d, "orders").where("o_orderstatus = 'F'"), F.col("o_custkey") == F.col("c_custkey"))
    return re_.distinct_sorted(j, ["c_custkey", "c_mktsegment"], "c_custkey", ["c_name"])


@query("SELECT n_nationkey::VARCHAR AS v FROM nation UNION SELECT r_name FROM region UNION SELECT n_regionkey::VARCHAR FROM nation")
def union_mixed(s, d):
    n, r = _t(s, d, "nation"), _t(s, d, "region")
    return re_.union(n.select(F.col("n_nationkey").alias("v")), r.select("r_name"), n.select("n_regionkey"))


@query("(SELECT c_custkey AS k, c_acctbal AS v FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 7) UNION ALL (SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 5)")
def union_all_limited(s, d):
    c, p = _t(s, d, "customer").select("c_custkey", "c_acctbal"), _t(s, d, "supplier").select("s_suppkey", "s_acctbal")
    return re_.union_all(re_.page(c, ["-c_acctbal", "c_custkey"], 7).toDF("k", "v"), re_.page(p, ["-s_acctbal", "s_suppkey"], 5))


@query("SELECT o_orderkey, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS found FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey DESC LIMIT 10 OFFSET 3")
def found_rows(s, d):
    return re_.page_and_found(_t(s, d, "orders").where("o_orderstatus = 'O'").select("o_orderkey"), ["-o_orderkey"], 10, 3)


@query("SELECT (SELECT count(*) FROM orders) AS orders, (SELECT max(s_acctbal) FROM supplier) AS richest, (SELECT r_name FROM region WHERE r_regionkey = 3) AS region")
def one_row(s, d):
    return re_.one_row(s, orders=_t(s, d, "orders").agg(F.count(F.lit(1))), richest=_t(s, d, "supplier").agg(F.max("s_acctbal")), region=_t(s, d, "region").where("r_regionkey = 3").select("r_name"))


@query("SELECT CASE WHEN p_size > 25 THEN '1' ELSE '0' END AS v FROM part UNION SELECT p_type FROM part")
def union_booleans(s, d):
    p = _t(s, d, "part")
    return re_.union(p.select((F.col("p_size") > 25).alias("v")), p.select("p_type"))


# Row changes


@query("""SELECT * FROM customer UNION ALL SELECT c_custkey + 1000000, 'copy', c_nationkey, 0, NULL FROM customer WHERE c_acctbal < 0""")
def change_insert(s, d):
    t = _t(s, d, "customer")
    new = t.where("c_acctbal < 0").select((F.col("C_CUSTKEY") + 1000000).alias("C_CUSTKEY"), F.lit("copy").alias("c_name"), "c_nationkey")
    return ch.insert(t, new, {"c_acctbal": 0.0})


@query("""SELECT * FROM supplier UNION ALL
SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY s_suppkey), s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal > 5000""")
def change_identity(s, d):
    t = _t(s, d, "supplier")
    new = t.where("s_acctbal > 5000").withColumn("old", F.col("s_suppkey")).withColumn("s_suppkey", F.lit(0).cast("bigint"))
    return ch.insert(t, ch.with_identity(new, "s_suppkey", ["old"], ch.highest_identity(t, "s_suppkey")).drop("old"))


@query("""SELECT * FROM part UNION ALL SELECT p_partkey + 100, p_name, p_brand, p_type, p_size, p_retailprice FROM part p WHERE p_partkey + 100 NOT IN (SELECT p_partkey FROM part)""")
def change_insert_ignore(s, d):
    t = _t(s, d, "part")
    return ch.insert_ignore(t, t.withColumn("p_partkey", F.col("p_partkey") + 100), [["p_partkey"]], ["p_partkey"])


@query("""SELECT c.c_custkey, c.c_name, c.c_nationkey, CASE WHEN n.k IS NULL THEN c.c_acctbal ELSE c.c_acctbal + n.v END AS c_acctbal, c.c_mktsegment
FROM customer c LEFT JOIN (SELECT o_custkey AS k, sum(o_totalprice) AS v FROM orders GROUP BY 1) n ON n.k = c.c_custkey
UNION ALL SELECT -1 - c_custkey, 'new', c_nationkey, 1, 'NONE' FROM customer WHERE c_custkey % 10 = 0""")
def change_upsert(s, d):
    t = _t(s, d, "customer")
    paid = _t(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("c_acctbal"))
    fresh = t.where("c_custkey % 10 = 0").select((-1 - F.col("c_custkey")).alias("c_custkey"), F.lit("new").alias("c_name"), "c_nationkey", F.lit(1.0).alias("c_acctbal"), F.lit("NONE").alias("c_mktsegment"))
    rows = ch.with_defaults(paid, t).unionByName(fresh)
    return ch.upsert(t, rows, ["c_custkey"], {"c_acctbal": F.col("old.c_acctbal") + F.col("new.c_acctbal")})


@query("""SELECT * FROM nation WHERE n_nationkey NOT IN (SELECT n_regionkey FROM nation WHERE n_regionkey <> 2) AND n_name NOT IN (SELECT r_name FROM region)
UNION ALL SELECT r_regionkey, r_name, 0 FROM region WHERE r_regionkey <> 2""")
def change_replace(s, d):
    rows = _t(s, d, "region").where("r_regionkey <> 2").select(F.col("r_regionkey").alias("n_nationkey"), F.col("r_name").alias("n_name"), F.lit(0).alias("n_regionkey"))
    return ch.replace(_t(s, d, "nation"), rows, [["n_nationkey"], ["n_name"]])


@query("""SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0 ORDER BY s_acctbal DESC, s_suppkey LIMIT 3) THEN 0 ELSE s_acctbal END AS s_acctbal FROM supplier""")
def change_update_limited(s, d):
    t = _t(s, d, "supplier")
    return ch.update(t, {"s_acctbal": F.lit(0)}, F.col("s_acctbal") > 0, ["s_suppkey"], [F.col("s_acctbal").desc_nulls_last()], 3)


@query("SELECT event_id, ts, user_id, event_type, CASE WHEN event_type = 'click' THEN value * 2 ELSE value END AS value, props FROM events")
def change_update(s, d):
    t = _t(s, d, "events")
    return ch.update(t, {"value": F.col("value") * 2}, co.compare(t, "event_type", "=", "click"))


@query("SELECT * FROM events WHERE NOT coalesce(value > 90, false)")
def change_delete(s, d):
    t = _t(s, d, "events")
    return ch.delete(t, co.compare(t, "value", ">", 90))


@query("SELECT * FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE value IS NOT NULL ORDER BY value, event_id LIMIT 50)")
def change_delete_limited(s, d):
    t = _t(s, d, "events")
    return ch.delete(t, F.col("value").isNotNull(), ["event_id"], [F.col("value").asc_nulls_first()], 50)


@query("SELECT event_id, user_id FROM events e WHERE event_id = (SELECT max(event_id) FROM events i WHERE i.user_id = e.user_id) OR user_id IS NULL")
def change_delete_older(s, d):
    return ch.delete_older_of_group(_t(s, d, "events").select("event_id", "user_id"), "user_id", "event_id")


@query("SELECT * FROM supplier WHERE s_suppkey NOT IN (SELECT a.s_suppkey FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey > b.s_suppkey)")
def change_delete_self_join(s, d):
    return ch.delete_joined(_t(s, d, "supplier"), (F.col("a.s_nationkey") == F.col("b.s_nationkey")) & (F.col("a.s_suppkey") > F.col("b.s_suppkey")), "s_suppkey")


# Schema and whole tables


@query("SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1")
def key_duplicates(s, d):
    return re_.duplicates(_t(s, d, "orders"), ["o_custkey"])


@query("""SELECT 'name' AS column_name, count(*) FILTER (length(c_name) > 12) AS cut, 0 AS unconvertible, 0 AS negative, count(*) FILTER (c_name IS NULL) AS nulls FROM customer
UNION ALL SELECT 'balance', 0, count(*) FILTER (c_acctbal <> floor(c_acctbal)), count(*) FILTER (c_acctbal < 0), 0 FROM customer""")
def schema_losses(s, d):
    t = _t(s, d, "customer")
    a = sc.losses(t, "c_name", "varchar(12)", not_null=True).select(F.lit("name").alias("column_name"), "*")
    return a.unionByName(sc.losses(t, "c_acctbal", "bigint unsigned").select(F.lit("balance").alias("column_name"), "*"))


@query("SELECT r_regionkey::BIGINT AS id, r_name, 'none' AS note FROM region")
def schema_alter(s, d):
    t = sc.modify_column(_t(s, d, "region"), "r_regionkey", "bigint")
    return sc.add_column(sc.rename_column(t, "r_regionkey", "id"), "note", "varchar(10)", "none")


@query("SELECT 'orders' AS table_name, count(*) AS table_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def table_status(s, d):
    return re_.table_status({n: _t(s, d, n) for n in ("orders", "lineitem", "events")})


@query("""WITH t AS (SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type, p_size::VARCHAR AS p_size, p_retailprice::VARCHAR AS p_retailprice FROM part),
u AS (UNPIVOT (SELECT row_number() OVER () AS k, * FROM t) ON p_partkey, p_name, p_brand, p_type, p_size, p_retailprice INTO NAME "column" VALUE v)
SELECT "column", (SELECT count(*) FROM part) - count(*) AS nulls, count(*) FILTER (contains(v, chr(0)))::BIGINT AS nuls, max(strlen(v)) AS longest, count(*) FILTER (strlen(v) > 20) AS over FROM u GROUP BY "column"
UNION ALL SELECT '*', 0, 0, max(n), count(*) FILTER (n > 40) FROM (SELECT sum(strlen(v))::BIGINT AS n FROM u GROUP BY k)""")
def archive_preflight(s, d):
    return archive.preflight(_t(s, d, "part"), 20, 40)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def archive_cells(s, d):
    t = _t(s, d, "events")
    cells = archive.encoded(t).select(F.from_json("row", "array<string>").alias("cells"))
    return cells.select(*[archive._value(F.unbase64(F.get("cells", F.lit(i))), f.dataType).alias(f.name) for i, f in enumerate(t.schema)])


@query("SELECT count(*) AS rows, true AS same FROM lineitem")
def archive_digest(s, d):
    t = _t(s, d, "lineitem")
    both = archive.digest(t).union(archive.digest(t.repartition("l_partkey")))
    return both.groupBy("rows").agg((F.countDistinct("digest") == 1).alias("same"))


@query("SELECT * FROM orders")
def export_restore(s, d):
    t = _t(s, d, "orders")
    folder = scratch.new_folder(s)
    return archive.restore(s, f"{folder}/out", archive.export(t, f"{folder}/out"), f"{folder}/in")


@query("SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal FROM supplier")
def verified_rewrite(s, d):
    return archive.rewrite(sc.modify_column(_t(s, d, "supplier"), "s_nationkey", "bigint"), scratch.new_folder(s))


# Operands of any type


@query("""SELECT p_partkey, try_cast(regexp_extract(p_brand, '[0-9]+') AS DOUBLE) >= p_size AS above, p_size::DOUBLE IS NOT DISTINCT FROM try_cast(regexp_extract(p_brand, '[0-9]+') AS DOUBLE) AS same, (p_size > 20)::INT = p_size % 2 AS flag
FROM part WHERE try_cast(regexp_extract(p_brand, '[0-9]+') AS DOUBLE) <> p_size - 1""")
def column_comparison(s, d):
    p = _t(s, d, "part").withColumn("tail", F.concat(F.substring("p_brand", 7, 9), F.lit(" or so")))
    wanted = p.where(co.compare(p, "tail", "<>", F.col("p_size") - 1))
    return wanted.select("p_partkey", co.compare(p, "tail", ">=", F.col("p_size")).alias("above"), co.compare(p, "p_size", "<=>", F.col("tail")).alias("same"), co.compare(p, F.col("p_size") > 20, "=", F.col("p_size") % 2).alias("flag"))


@query("""SELECT o_orderkey, o_orderdate >= ('1997-0' || left(o_orderpriority, 1) || '-01')::TIMESTAMP AS later, month(o_orderdate) <= 6 AS early FROM orders WHERE month(o_orderdate) IN (2, 3, 7, 11)""")
def time_comparison(s, d):
    o = _t(s, d, "orders")
    month, text = cal.date_format(F.col("o_orderdate"), "%m"), F.concat(F.lit("1997-0"), F.left("o_orderpriority", F.lit(1)), F.lit("-01"))
    return o.where(co.within(o, month, [2, 3, 7, 11])).select("o_orderkey", co.compare(o, "o_orderdate", ">=", text).alias("later"), co.compare(o, month, "<=", 6).alias("early"))


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY'")
def same_text_any_case(s, d):
    lower = F.lower("c_mktsegment")
    return _t(s, d, "customer").where(co.same_text(lower, F.lit("Building"), ignore_case=True) | co.same_text(F.upper(lower), F.lit("MACHINERY"))).select("c_custkey")


@query("""SELECT p_partkey, p_size <> 7 AND no <> 3 AS every, p_size <> 7 OR no <> 3 AS some, no = 3 AS nothing, (p_size <> 7) <> (no <> 3) AS one, CASE WHEN no <> 3 THEN p_size::VARCHAR ELSE 'three' END AS chosen,
CASE WHEN p_size <> 7 AND no > 20 THEN 'many' WHEN no <> 3 THEN '1' ELSE '0' END AS ranked, CASE WHEN no = 3 THEN 30 WHEN no = 4 THEN 40 END AS simple, CASE WHEN no = p_size THEN 1 WHEN no = 3 THEN 2 ELSE 0 END AS place
FROM (SELECT *, regexp_extract(p_brand, '[0-9]+')::INT AS no FROM part)""")
def conditions(s, d):
    p = _t(s, d, "part").withColumn("no", F.concat(F.substring("p_brand", 7, 9), F.lit(" x")))
    p = p.withColumn("three", F.when(co.compare(p, "no", "<>", 3), F.col("no")).otherwise("x"))
    left = F.col("p_size") - 7
    return p.select(
        "p_partkey", co.all_of(p, left, "three").alias("every"), co.any_of(p, left, "three").alias("some"), co.none_of(p, "three").alias("nothing"), co.xor(p, left, "three").alias("one"),
        co.if_(p, "three", "p_size", F.lit("three")).alias("chosen"), co.case(p, (co.all_of(p, left, co.compare(p, "no", ">", 20)), F.lit("many")), ("three", F.lit(True)), otherwise=F.lit(False)).alias("ranked"),
        co.case_of(p, "no", (3, 30), (4, 40)).alias("simple"), co.field(p, "no", F.col("p_size"), 3).alias("place"),
    )


@query("""SELECT p_partkey, no + p_size AS added, no - 0.5 AS less, no * no AS squared, -no AS turned, no / nullif(p_size - 5, 0) AS ratio, no % 4 AS rest, trunc(no / 4)::BIGINT AS whole, (no::BIGINT | 64) AS bits
FROM (SELECT *, regexp_extract(p_brand, '[0-9]+')::DOUBLE AS no FROM part)""")
def text_arithmetic(s, d):
    p = _t(s, d, "part").withColumn("no", F.concat(F.lit(" "), F.substring("p_brand", 7, 9), F.lit("th")))
    return p.select(
        "p_partkey", nu.plus(p, "no", "p_size").alias("added"), nu.minus(p, "no", 0.5).alias("less"), nu.times(p, "no", "no").alias("squared"), nu.negative(p, "no").alias("turned"), nu.divide(p, "no", F.col("p_size") - 5).alias("ratio"),
        nu.modulo(p, "no", 4).alias("rest"), nu.int_divide(p, "no", 4).alias("whole"), nu.bits_or(p, "no", 64).alias("bits"),
    )


@query("""SELECT o_orderkey, (9007199254740993 + o_orderkey) // 7 AS whole, -((9007199254740993 + o_orderkey) // 2) AS below, (n // 10000)::VARCHAR || '.' || lpad((n % 10000)::VARCHAR, 4, '0') AS exact
FROM (SELECT *, ((o_orderkey + 1) * 20000 + 7) // 14 AS n FROM orders)""")
def exact_division(s, d):
    o = _t(s, d, "orders")
    large = F.col("o_orderkey") + F.lit(9007199254740993)
    return o.select("o_orderkey", nu.int_divide(o, large, 7).alias("whole"), nu.int_divide(o, -large, 2).alias("below"), nu.divide(o, F.col("o_orderkey") + 1, 7).cast("string").alias("exact"))


@query("SELECT l_orderkey, l_linenumber, l_orderkey << 3 AS up, l_orderkey >> 2 AS down, -l_orderkey - 1 AS turned, 0::BIGINT AS gone FROM lineitem")
def bit_shifts(s, d):
    t = _t(s, d, "lineitem")
    return t.select("l_orderkey", "l_linenumber", nu.shift_left(t, "l_orderkey", 3).alias("up"), nu.shift_right(t, "l_orderkey", 2).alias("down"), nu.bits_not(t, "l_orderkey").alias("turned"), nu.shift_left(t, "l_orderkey", 64).alias("gone"))


@query("SELECT c_custkey, abs(c_acctbal) AS size, ceil(c_acctbal)::BIGINT AS up, floor(c_acctbal)::BIGINT AS down, round(c_acctbal)::BIGINT AS near FROM customer")
def number_functions(s, d):
    return _t(s, d, "customer").select("c_custkey", F.abs("c_acctbal").alias("size"), F.ceil("c_acctbal").alias("up"), F.floor("c_acctbal").alias("down"), F.round("c_acctbal").cast("bigint").alias("near"))


@query("""SELECT p_type, sum(no) AS total, sum(DISTINCT no) AS total_distinct, round(avg(no), 6) AS mean, round(avg(DISTINCT no), 6) AS mean_distinct, count(*) FILTER (p_size > 20) AS large
FROM (SELECT *, regexp_extract(p_brand, '[0-9]+')::DOUBLE AS no FROM part) GROUP BY p_type""")
def text_sums(s, d):
    p = _t(s, d, "part").withColumn("no", F.concat(F.substring("p_brand", 7, 9), F.lit("th")))
    sums = [nu.total(p, "no").alias("total"), nu.total(p, "no", distinct=True).alias("total_distinct"), F.round(nu.mean(p, "no"), 6).alias("mean"), F.round(nu.mean(p, "no", distinct=True), 6).alias("mean_distinct")]
    return p.groupBy("p_type").agg(*sums, nu.total(p, F.col("p_size") > 20).alias("large"))


@query("SELECT r_name, string_agg(n_name, '; ' ORDER BY n_nationkey DESC) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def group_concat_by(s, d):
    j = _t(s, d, "region").join(_t(s, d, "nation"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name").agg(tx.group_concat(F.col("n_name"), "; ", descending=True, by=F.col("n_nationkey")).alias("nations"))


@query("""SELECT event_id, (value > 50)::INT::VARCHAR AS flag, NULL::DATE AS no_date, ts::DATE AS day, date_trunc('second', ts) AS whole, strftime(ts, '%H:%M:%S') AS clock, NULL::VARCHAR AS no_clock, printf('%.2f', value) AS amount, value AS number,
user_id AS signed, user_id::DECIMAL(20, 0)::VARCHAR AS unsigned, props AS json, NULL::VARCHAR AS no_json, ts::DATE AS day_digits FROM events""")
def casts(s, d):
    e = _t(s, d, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return e.select(
        "event_id", nu.as_char(e, F.col("value") > 50).alias("flag"), nu.as_date(e, "event_type").alias("no_date"), nu.as_date(e, text).alias("day"), nu.as_datetime(e, text).alias("whole"), nu.as_time(e, text).alias("clock"), nu.as_time(e, "event_type").alias("no_clock"),
        nu.as_decimal(e, F.concat("value", F.lit(" EUR")), 12, 2).cast("string").alias("amount"), nu.as_double(e, F.concat("value", F.lit(" EUR"))).alias("number"), nu.signed(e, F.concat("user_id", F.lit(".2x"))).alias("signed"),
        nu.unsigned(e, F.concat("user_id", F.lit("u"))).cast("string").alias("unsigned"), nu.as_json(e, "props").alias("json"), nu.as_json(e, "event_type").alias("no_json"), nu.as_date(e, F.date_format("ts", "yyyyMMdd").cast("int")).alias("day_digits"),
    )


# Calendar, continued


@query("SELECT event_id, hour(ts)::INT AS h, minute(ts)::INT AS m, second(ts)::INT AS s, epoch(ts)::DOUBLE AS unix FROM events")
def clock_parts(s, d):
    c = F.col("ts")
    return _t(s, d, "events").select("event_id", cal.hour(c).alias("h"), cal.minute(c).alias("m"), cal.second(c).alias("s"), cal.unix_timestamp(c).alias("unix"))


@query("""SELECT event_id, strftime(ts, '%a %b %-m %-d %f %I %j %-H %-I %B %p %I:%M:%S %p %S %H:%M:%S %A %w %y 100%%') AS long,
day(ts) || CASE WHEN day(ts) BETWEEN 11 AND 13 THEN 'th' WHEN day(ts) % 10 = 1 THEN 'st' WHEN day(ts) % 10 = 2 THEN 'nd' WHEN day(ts) % 10 = 3 THEN 'rd' ELSE 'th' END AS ordinal, strftime(ts, '%U %W') AS weeks, strftime(ts, '%V %G') AS iso FROM events""")
def date_formats(s, d):
    c = F.col("ts")
    return _t(s, d, "events").select("event_id", cal.date_format(c, "%a %b %c %e %f %h %j %k %l %M %p %r %s %T %W %w %y 100%%").alias("long"), cal.date_format(c, "%D").alias("ordinal"), F.concat(cal.date_format(c, "%U "), F.lpad(cal.week(c, 5).cast("string"), 2, "0")).alias("weeks"), cal.date_format(c, "%v %x").alias("iso"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE year(o_orderdate) END::INT AS y, CASE WHEN o_orderkey % 3 > 0 THEN dayofyear(o_orderdate) END::INT AS doy, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE epoch(o_orderdate) END::DOUBLE AS unix,
CASE WHEN o_orderkey % 3 = 0 THEN '0000-00-00' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS text, CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate + INTERVAL 1 DAY END AS next FROM orders""")
def zero_dates(s, d):
    o = _t(s, d, "orders")
    t = o.withColumn("day", co.if_(o, F.col("o_orderkey") % 3, "o_orderdate", F.lit(co.ZERO_DATE).cast("timestamp_ntz")))
    c = F.col("day")
    return t.select("o_orderkey", cal.year(c).alias("y"), cal.day_of_year(c).alias("doy"), cal.unix_timestamp(c).alias("unix"), cal.date_format(c, "%Y-%m-%d").alias("text"), cal.add(c, F.lit(1), "day").alias("next"))


@query("SELECT count(*) AS n, count(*) AS days, count(*) AS utc, count(*) AS later, count(*) AS drawn FROM events")
def until_now(s, d):
    e, c = _t(s, d, "events").withColumn("drawn", F.rand()), F.col("ts")
    count = lambda x: F.count(F.when(x, 1))
    clocks = F.length(cal.time_of_day()) + F.length(cal.utc_time_of_day()) == 16
    return e.agg(count(c <= cal.now()).alias("n"), count((c <= cal.today()) & (c <= cal.utc_today())).alias("days"), count((c <= cal.utc_now()) & clocks).alias("utc"), count(cal.add(c, F.lit(1), "day") < cal.now()).alias("later"), count(F.col("drawn") < 1).alias("drawn"))


# Row changes whose rows conflict with one another


# Rows in sixes, each sharing one name or the other with the next: those at even places go in.
@query("""SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier UNION ALL SELECT NULL, 'a' || (s_suppkey // 6 * 10 + s_suppkey % 6 // 2), (1000 + s_suppkey // 6 * 10 + (s_suppkey % 6 + 1) // 2)::INT, s_acctbal FROM supplier WHERE s_suppkey % 6 % 2 = 0""")
def change_insert_ignore_keys(s, d):
    t = _t(s, d, "supplier")
    block, place = F.floor(F.col("s_suppkey") / 6) * 10, F.col("s_suppkey") % 6
    # The table's own nations repeat, but no new row has one of them.
    new = t.select(F.lit(None).cast("bigint").alias("s_suppkey"), F.concat(F.lit("a"), (block + F.floor(place / 2)).cast("string")).alias("s_name"), (1000 + block + F.floor((place + 1) / 2)).cast("int").alias("s_nationkey"), "s_acctbal", F.col("s_suppkey").alias("turn"))
    wide = t.withColumn("turn", F.lit(-1).cast("bigint"))
    return ch.insert_ignore(wide, new, [["s_suppkey"], ["s_name"], ["s_nationkey"]], ["turn"]).drop("turn")


@query("""SELECT r_regionkey, r_name || '+' || (SELECT string_agg(n_name, '+' ORDER BY n_nationkey) FROM nation WHERE n_regionkey = r_regionkey) AS r_name FROM region
UNION ALL SELECT 100, 'first+' || string_agg(n_name, '+' ORDER BY n_nationkey) FILTER (n_nationkey <> 3) FROM nation WHERE n_nationkey BETWEEN 3 AND 6""")
def change_upsert_repeated(s, d):
    r, n = _t(s, d, "region"), _t(s, d, "nation")
    far = n.where("n_nationkey BETWEEN 3 AND 6").select(F.lit(100).alias("r_regionkey"), F.when(F.col("n_nationkey") == 3, "first").otherwise(F.col("n_name")).alias("r_name"), (F.col("n_nationkey") + 1000).alias("turn"))
    rows = n.select(F.col("n_regionkey").alias("r_regionkey"), F.col("n_name").alias("r_name"), F.col("n_nationkey").alias("turn")).unionByName(far)
    wide = r.withColumn("turn", F.lit(-1))
    return ch.upsert(wide, rows, ["r_regionkey"], {"r_name": F.concat("old.r_name", F.lit("+"), "new.r_name")}, order=["turn"]).drop("turn")


@query("""WITH new AS (SELECT s_nationkey AS n_nationkey, 'S' || s_suppkey % 40 AS n_name, (s_suppkey % 7)::INT AS n_regionkey, s_suppkey FROM supplier)
SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey NOT IN (SELECT n_nationkey FROM new) AND n_name NOT IN (SELECT n_name FROM new)
UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM (SELECT *, max(s_suppkey) OVER (PARTITION BY n_nationkey) AS a, max(s_suppkey) OVER (PARTITION BY n_name) AS b FROM new) WHERE s_suppkey = a AND s_suppkey = b""")
def change_replace_repeated(s, d):
    n = _t(s, d, "nation").withColumn("turn", F.lit(-1).cast("bigint"))
    rows = _t(s, d, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), F.concat(F.lit("S"), (F.col("s_suppkey") % 40).cast("string")).alias("n_name"), (F.col("s_suppkey") % 7).cast("int").alias("n_regionkey"), F.col("s_suppkey").alias("turn"))
    return ch.replace(n, rows, [["n_nationkey"], ["n_name"]], order=["turn"]).drop("turn")
