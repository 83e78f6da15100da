"""Functions and operators of the library on small tables, with nulls, ties and odd values."""

import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mizzen.functions import calendar as cal
from mizzen.functions import coercion as co
from mizzen.functions import numbers as nu
from mizzen.functions import texts as tx
from mizzen.operators import changes as ch
from mizzen.operators import relational as re_
from mizzen.operators import schema as sc
from mizzen.sources import archive


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def values(spark, items, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.select(build(F.col("v")).alias("x"), "i").orderBy("i").collect()]


def test_numbers_of_text(spark):
    items = [" -12.5tail", "1e3x", "abc", "", None, "+.5", "5.", "\t7", "1e", "--1", "9" * 40]
    assert values(spark, items, co.number_of) == [-12.5, 1000.0, 0.0, 0.0, None, 0.5, 5.0, 7.0, 1.0, 0.0, float("9" * 40)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=" \t+-.eE019ax", max_size=8), min_size=1, max_size=30))
def test_number_prefix_property(spark, items):
    pattern = re.compile(r"[ \t\n\r\x0b\f]*([+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?)")
    want = [float(m[1]) if (m := pattern.match(x)) else 0.0 for x in items]
    assert values(spark, items, co.number_of) == want


def test_truth_and_comparison(spark):
    df = spark.createDataFrame([(1, "5 apples", True), (2, "x", False), (3, None, None), (4, "F", True)], "i int, t string, b boolean")
    assert [r[0] for r in df.orderBy("i").select(co.truth(F.col("t"), T.StringType())).collect()] == [True, False, None, False]
    assert [r[0] for r in df.orderBy("i").select(co.numeric(F.col("b"), T.BooleanType())).collect()] == [1, 0, None, 1]
    ask = lambda c: [r.i for r in df.where(c).orderBy("i").collect()]
    assert ask(co.compare(df, "t", "=", 5)) == [1] and ask(co.compare(df, "t", "=", 0)) == [2, 4]
    assert ask(co.compare(df, "i", ">=", "3 or so")) == [3, 4] and ask(co.compare(df, "t", "<=>", None)) == [3] and ask(co.compare(df, "t", "=", None)) == []
    assert ask(co.within(df, "t", ["x", 5])) == [1, 2] and ask(~co.within(df, "i", [1, None])) == []
    assert ask(co.between(df, "i", "2", 3)) == [2, 3]
    assert ask(co.is_false(F.col("t"), T.StringType())) == [2, 4] and ask(co.is_true(F.col("b"), T.BooleanType())) == [1, 4]
    assert ask(co.like(F.col("t"), "f")) == [4] and ask(co.like(F.col("t"), "f", binary=True)) == []
    with pytest.raises(ValueError):
        co.like(F.col("t"), "a", "!", binary=True)
    with pytest.raises(ValueError):
        co.within(df, "t", [])


def test_division(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (1, 0), (None, 1)], "a int, b int")
    out = df.select(nu.divide(df, "a", "b").cast("double"), nu.modulo(df, "a", "b"), nu.int_divide(df, "a", "b")).collect()
    assert [tuple(r) for r in out] == [(3.5, 1, 3), (-3.5, -1, -3), (None, None, None), (None, None, None)]
    big = spark.createDataFrame([(9007199254740993, 1, "7.5 kg"), (-9007199254740993, 2, None)], "a long, b int, t string")
    assert [r[0] for r in big.select(nu.int_divide(big, "a", "b")).collect()] == [9007199254740993, -4503599627370496]
    assert [str(r[0]) for r in big.select(nu.divide(big, "a", "b")).collect()] == ["9007199254740993.0000", "-4503599627370496.5000"]
    texts = big.select(nu.plus(big, "t", 1), nu.divide(big, "t", 2), nu.int_divide(big, "t", 2), nu.modulo(big, "t", 2), nu.negative(big, "t"), nu.shift_left(big, "b", 63), nu.shift_left(big, "b", 64), nu.shift_right(big, F.lit(-1), 63), nu.bits_not(big, "b")).first()
    assert tuple(texts) == (8.5, 3.75, 3, 1.5, -7.5, -(2**63), 0, 1, -2)
    sums = spark.createDataFrame([("1a",), ("1b",), ("x",), (None,)], "t string")
    assert tuple(sums.agg(nu.total(sums, "t"), nu.total(sums, "t", True), nu.mean(sums, "t", True)).first()) == (2.0, 1.0, 0.5)


def test_casts(spark):
    df = spark.createDataFrame([("2024-02-30", "12.345kg", True), ("20240229", "x", None), ("0000-00-00 01:02:03", "-1e2", False), (None, None, None), (" 2024-1-5 10:11:12.5", "99999", True)], "d string, n string, b boolean")
    got = [tuple(r) for r in df.select(nu.as_date(df, "d"), nu.as_datetime(df, "d"), nu.as_time(df, "d"), nu.as_decimal(df, "n", 6, 2).cast("string"), nu.signed(df, "n"), nu.as_char(df, "b")).collect()]
    day, zero = dt.date(2024, 2, 29), dt.date(1, 1, 1)
    assert got == [
        (None, None, None, "12.35", 12, "1"),
        (day, dt.datetime(2024, 2, 29), None, "0.00", 0, None),
        (zero, dt.datetime(1, 1, 1, 1, 2, 3), "01:02:03", "-100.00", -100, "0"),
        (None, None, None, None, None, None),
        (dt.date(2024, 1, 5), dt.datetime(2024, 1, 5, 10, 11, 12, 500000), "10:11:12", None, 99999, "1"),
    ]
    docs = spark.createDataFrame([('{"a": 1}',), ("{a",), (None,)], "j string")
    assert [r[0] for r in docs.select(nu.as_json(docs, "j")).collect()] == ['{"a": 1}', None, None]


def test_columns_meet(spark):
    df = spark.createDataFrame([(1, "1 kg", 5, dt.date(2024, 1, 2), "2024-01-02", True), (2, "x", 0, None, "no date", False), (3, None, None, dt.date(2024, 1, 1), None, None)], "i int, t string, n int, d date, s string, b boolean")
    pick = lambda c: [r[0] for r in df.orderBy("i").select(c).collect()]
    assert pick(co.compare(df, "t", "=", F.col("i"))) == [True, False, None] and pick(co.compare(df, "i", ">", F.col("t"))) == [False, True, None]
    assert pick(co.compare(df, "d", "=", F.col("s"))) == [True, None, None] and pick(co.compare(df, "s", "<=>", F.col("d"))) == [True, True, False]
    assert pick(co.compare(df, "b", "=", F.col("t"))) == [True, True, None] and pick(co.compare(df, "b", "=", "1 or so")) == [True, False, None]
    assert pick(co.all_of(df, "t", "n")) == [True, False, None] and pick(co.any_of(df, "t", "b")) == [True, False, None] and pick(co.none_of(df, "n")) == [False, True, None]
    assert pick(co.if_(df, "t", "i", F.lit("none"))) == ["1", "none", "none"] and pick(co.if_(df, "b", F.lit(True), 7)) == [1, 7, 7]
    assert pick(co.case(df, ("n", "t"), (F.col("i") - 3, F.lit(True)), otherwise=F.lit("z"))) == ["1 kg", "1", "z"]
    assert pick(co.case_of(df, "t", (1, "i"), ("x", 9))) == [1, 9, None] and pick(co.field(df, "t", 1, 0)) == [1, 2, 0]
    assert pick(tx.concat(df, "b", F.lit(":"), "i")) == ["1:1", "0:2", None]
    marked = sc.declared_json(df, "t")
    for ask in (lambda: co.compare(marked, "t", "=", "x"), lambda: co.within(marked, "t", ["x"]), lambda: co.between(marked, F.col("t"), 1, 2), lambda: co.compare(marked, "i", "=", F.col("t"))):
        with pytest.raises(ValueError):
            ask()


def test_not_in(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    other = lambda *v: spark.createDataFrame([(x,) for x in v], "o int")
    ask = lambda f, *v: rows(f(df, "k", other(*v), "o"))
    assert ask(re_.not_in_rows, 1) == [(2,)] and ask(re_.not_in_rows, 1, None) == [] and ask(re_.not_in_rows) == rows(df)
    assert ask(re_.in_rows, 1, 1, None) == [(1,)] and ask(re_.in_rows) == []


def test_texts(spark):
    assert values(spark, ["hello", "ab", None], lambda c: tx.substring(c, -3, 2)) == ["ll", "", None]
    assert values(spark, ["hello", None], lambda c: tx.substring(c, 0)) == ["", None]
    g = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (1, None), (2, None)], "k int, v string").groupBy("k").agg(tx.group_concat(F.col("v")).alias("a"), tx.group_concat(F.col("v"), "", True, True).alias("d"))
    assert rows(g) == [(1, "a,a,b", "ba"), (2, None, None)]
    by = spark.createDataFrame([(2, "b"), (None, "c"), (1, "z"), (2, "a"), (0, None)], "k int, v string")
    assert by.agg(tx.group_concat(F.col("v"), by=F.col("k"))).first()[0] == "c,z,a,b" and by.agg(tx.group_concat(F.col("v"), descending=True, by=F.col("k"))).first()[0] == "b,a,z,c"
    with pytest.raises(ValueError):
        tx.group_concat(F.col("v"), distinct=True, by=F.col("k"))


def week_by_counting(day, mode):
    """A week belongs to the year of its first day, or to the one that has four of its days."""
    offset = day.weekday() if mode & 1 else (day.weekday() + 1) % 7
    start = day - dt.timedelta(offset)
    days = [start + dt.timedelta(k) for k in range(7)]
    owner = lambda ds: ds[3].year if mode in (1, 3, 4, 6) else ds[0].year
    year = owner(days)
    n, d = 0, start
    while owner([d + dt.timedelta(k) for k in range(7)]) == year:
        n, d = n + 1, d - dt.timedelta(7)
    return n


def test_weeks(spark):
    days = [dt.date(y, 1, 1) + dt.timedelta(k) for y in range(2010, 2031) for k in range(-8, 9)] + [dt.date(2024, 2, 29)]
    for mode in range(8):
        got = values(spark, days, lambda c: cal.week(c, mode), "date")
        for day, n in zip(days, got):
            if mode & 2:
                assert n == week_by_counting(day, mode), (day, mode)
            else:
                # Counted from the year's first week, which the 2 modes also count from; days before it are in week 0.
                twin = {0: 2, 1: 3, 4: 6, 5: 7}[mode]
                first = next(d for d in (dt.date(day.year, 1, 1) - dt.timedelta(6) + dt.timedelta(k) for k in range(14)) if week_by_counting(d, twin) == 1)
                assert n == ((day - first).days // 7 + 1 if day >= first else 0), (day, mode)
    assert values(spark, [None, dt.date(1, 1, 1)], lambda c: cal.week(c, 0), "date") == [None, None]


def test_calendar(spark):
    d = [dt.datetime(2024, 3, 5, 7, 8, 9), None]
    assert values(spark, d, lambda c: cal.date_format(c, "%d %M '%y' %b %H:%i:%s 100%% of"), "timestamp_ntz") == ["05 March '24' Mar 07:08:09 100% of", None]
    assert values(spark, d, lambda c: cal.add(c, F.lit(1), "quarter"), "timestamp_ntz")[0] == dt.datetime(2024, 6, 5, 7, 8, 9)
    assert values(spark, d, lambda c: cal.subtract(c, F.lit(1.5), "hour"), "timestamp_ntz")[0] == dt.datetime(2024, 3, 5, 5, 38, 9)
    zero = [dt.datetime(1, 1, 1, 4, 5, 6)]
    assert values(spark, zero, lambda c: cal.date_format(c, "%Y-%m-%d %y %c %e %D %T"), "timestamp_ntz") == ["0000-00-00 00 0 0 0th 04:05:06"]
    for pattern in ("%M", "%a", "%j", "%U", "%x"):
        assert values(spark, zero, lambda c: cal.date_format(c, pattern), "timestamp_ntz") == [None]
    assert values(spark, zero, cal.year, "timestamp_ntz") == [0] and values(spark, zero, cal.unix_timestamp, "timestamp_ntz") == [0] and values(spark, zero, cal.hour, "timestamp_ntz") == [4]
    assert values(spark, d, lambda c: cal.date_format(c, "%D %e/%c %h%p %r %j %w %W %X %x %V %v %f"), "timestamp_ntz")[0] == "5th 5/3 07AM 07:08:09 AM 065 2 Tuesday 2024 2024 09 10 000000"
    try:
        for zone in ("America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert values(spark, [dt.datetime(1970, 1, 2, 0, 0, 0, 250000), None], cal.unix_timestamp, "timestamp_ntz") == [86400.25, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    with pytest.raises(ValueError):
        cal.date_format(F.col("v"), "%q")
    with pytest.raises(ValueError):
        cal.add(F.col("v"), F.lit(1), "fortnight")


def test_order_and_union(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y"), (3, None)], "n int, t string")
    assert [r.n for r in re_.ordered(a, "n").collect()] == [None, 1, 3] and [r.n for r in re_.ordered(a, "-n").collect()] == [3, 1, None]
    assert re_.found_rows(a) == 3 and [r.n for r in re_.page(a, ["n"], 1, 1).collect()] == [1]
    b = spark.createDataFrame([("q", 5)], "t string, n int")
    out = re_.union_all(a, b)
    assert out.dtypes == [("n", "string"), ("t", "string")] and out.count() == 4
    assert re_.union(a, a).count() == 3
    assert rows(re_.union_all(spark.createDataFrame([(True,), (None,)], "v boolean"), spark.createDataFrame([("x",)], "v string"))) == [("1",), ("x",), (None,)]
    assert [tuple(r) for r in re_.page_and_found(a, ["n"], 1, 1).collect()] == [(1, "x", 3)]
    with pytest.raises(ValueError):
        re_.union_all(a, b.select("t"))
    with pytest.raises(ValueError):
        re_.distinct_sorted(a, ["t"], "n", ["n"])
    assert rows(re_.duplicates(spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int"), ["k"])) == [(1, 2)]


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "a", 5), (2, "b", None), (3, None, 7)], "id long, name string, score int")


def test_insert(spark, people):
    new = spark.createDataFrame([("b", 1), ("c", 2), ("c", 3), (None, 4), (None, 5)], "NAME string, score int")
    out = ch.insert_ignore(people, new, [["name"]], ["score"])
    assert sorted((r.name or "", r.score or 0) for r in out.collect()) == [("", 4), ("", 5), ("", 7), ("a", 5), ("b", 0), ("c", 2)]
    two = spark.createDataFrame([("k", "p", 1), ("k", "q", 2), ("m", "q", 3), ("m", "r", 4), (None, "r", 5), (None, None, 6), (None, None, 7)], "b string, c string, n int")
    table = spark.createDataFrame([("x", "p", 0)], "b string, c string, n int")
    # (k, p) meets the table, so (k, q) goes in, (m, q) meets it, (m, r) goes in, and the next meets that.
    assert [r.n for r in ch.insert_ignore(table, two, [["b"], ["c"]], ["n"]).orderBy("n").collect()] == [0, 2, 4, 6, 7]
    with pytest.raises(ValueError):
        ch.insert(people, spark.createDataFrame([(1,)], "other int"))
    ask = spark.createDataFrame([(0, f"n{i:02}", i) for i in range(20)] + [(99, "given", 0), (None, "n99", 1)], "id long, name string, score int")
    got = ch.with_identity(ask, "id", ["name"], ch.highest_identity(people, "id"))
    assert sorted((r.name, r.id) for r in got.collect()) == sorted([("given", 99), *[(f"n{i:02}", 4 + i) for i in range(20)], ("n99", 24)])
    assert ch.highest_identity(people.limit(0), "id") == 0


def test_upsert_and_replace(spark, people):
    new = spark.createDataFrame([(1, "z", 10), (2, "y", None), (9, "w", 1)], "id long, name string, score int")
    out = ch.upsert(people, new, ["id"], {"score": F.coalesce("old.score", F.lit(0)) + F.coalesce("new.score", F.lit(1)), "name": F.col("new.name")})
    assert rows(out) == [(1, "z", 15), (2, "y", 1), (3, None, 7), (9, "w", 1)]
    assert rows(ch.replace(people, spark.createDataFrame([(1, "b", 0)], "id long, name string, score int"), [["id"], ["name"]])) == [(1, "b", 0), (3, None, 7)]


def test_repeated_keys(spark, people):
    new = spark.createDataFrame([(1, "z", 10), (1, "y", 20), (9, "w", 1), (9, "v", 2)], "id long, name string, score int")
    change = {"score": F.col("old.score") * 2 + F.col("new.score"), "name": F.col("new.name")}
    with pytest.raises(ValueError):
        ch.upsert(people, new, ["id"], change)
    assert rows(ch.upsert(people, new, ["id"], change, ["score"])) == [(1, "y", 60), (2, "b", None), (3, None, 7), (9, "v", 4)]
    again = spark.createDataFrame([(1, "b", 0), (5, "b", 1), (5, "c", 2), (6, None, 3)], "id long, name string, score int")
    with pytest.raises(ValueError):
        ch.replace(people, again, [["id"], ["name"]])
    assert rows(ch.replace(people, again, [["id"], ["name"]], ["score"])) == [(3, None, 7), (5, "c", 2), (6, None, 3)]


def test_update_and_delete(spark, people):
    assert rows(ch.update(people, {"score": F.col("score") + 1}, F.col("score") > 5)) == [(1, "a", 5), (2, "b", None), (3, None, 8)]
    assert rows(ch.update(people, {"score": F.lit(0), "name": F.col("score").cast("string")}, None, ["id"], [F.col("score").desc_nulls_last()], 1)) == [(1, "a", 5), (2, "b", None), (3, "7", 0)]
    assert rows(ch.delete(people, F.col("score") > 5)) == [(1, "a", 5), (2, "b", None)]
    assert rows(ch.delete(people, None, ["id"], [F.col("score").asc_nulls_first()], 2)) == [(3, None, 7)]
    assert ch.delete(people).count() == 0
    with pytest.raises(ValueError):
        ch.delete(people, limit=1)
    with pytest.raises(ValueError):
        ch.update(people, {}, limit=1)
    t = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, "b"), (6, "c"), (7, None)], "id long, name string")
    want = [(3, "a"), (5, "b"), (6, "c"), (7, None)]
    assert rows(ch.delete_older_of_group(t, "name", "id")) == want
    assert rows(ch.delete_joined(t, (F.col("a.name") == F.col("b.name")) & (F.col("a.id") < F.col("b.id")), "id")) == want
    assert rows(ch.delete_joined(t, (F.col("a.id") == 1) & (F.col("b.id") == 6), "id", ("a", "b"))) == [x for x in rows(t) if x[0] not in (1, 6)]


def test_schema(spark, people):
    assert tuple(sc.losses(people, "name", "varchar(0)", True).first()) == (2, 0, 0, 1)
    texts = spark.createDataFrame([("1",), ("x",), ("-2",), ("2.5",), (None,)], "v string")
    assert tuple(sc.losses(texts, "v", "bigint unsigned").first()) == (0, 2, 1, 0)
    assert sc.modify_column(people, "score", "bigint").schema["score"].dataType == T.LongType()
    for wrong in (lambda: sc.modify_column(people, "id", "tinyint"), lambda: sc.add_column(people, "ID", "int"), lambda: sc.rename_column(people, "id", "name"), lambda: sc.spark_type("geometry")):
        with pytest.raises(ValueError):
            wrong()
    assert sc.widens(T.DecimalType(5, 2), T.DecimalType(7, 3)) and not sc.widens(T.DecimalType(5, 2), T.DecimalType(6, 4))


def test_archive(spark, tmp_path):
    kinds = "i long, b binary, d decimal(20,4), t string, ts timestamp_ntz, day date, x double, a array<int>"
    data = [(1, b"\0\1\2\xff'\x80\\", __import__("decimal").Decimal("1234567890123456.1234"), 'q"\n\0', dt.datetime(2024, 1, 2, 3, 4, 5, 6), dt.date(1, 1, 1), 0.1, [1, None]), (None,) * 8, (None,) * 8]
    df = spark.createDataFrame(data, kinds)
    entry = archive.export(df, str(tmp_path / "out"))
    back = archive.restore(spark, str(tmp_path / "out"), entry, str(tmp_path / "in"))
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect())) and entry["rows"] == 3
    assert archive.verify(df.repartition(3), entry) and not archive.verify(df.limit(2), entry)
    assert not archive.verify(df.distinct(), entry)
    with pytest.raises(Exception):
        archive.export(df, str(tmp_path / "out"))
    for odd in (spark.createDataFrame([], "a int, A int"), spark.range(1).select(F.expr("INTERVAL '1' DAY").alias("i"))):
        with pytest.raises(ValueError):
            archive.export(odd, str(tmp_path / "odd"))
    with pytest.raises(ValueError):
        archive.unsupported(df.schema, 3)
    stats = {r.column: r for r in archive.preflight(df, 5, 10).collect()}
    assert stats["t"].nuls == 1 and stats["b"].longest == 7 and stats["b"].over == 1 and stats["i"].nulls == 2
    assert archive.digest(df.limit(0)).first().rows == 0
    assert archive.rewrite(df, str(tmp_path / "next")).count() == 3


def test_scratch(spark):
    from mizzen.sources import scratch

    df, path = scratch.stored(spark.range(5))
    assert df.count() == 5 and scratch.fits(df, 5) and not scratch.fits(df, 4)
    scratch.removed(spark, path)
    assert not list(spark.sparkContext._jvm.java.io.File(path.removeprefix("file:")).list() or [])
    assert scratch.cut(spark.range(0)).count() == 0
    scratch.cleared(spark)
    assert scratch.cut(spark.range(3)).count() == 3


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
