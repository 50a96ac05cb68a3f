import datetime
import io
import math
import random
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace import cli, functions as fn, migrations
from millrace.errors import InvalidQuery, MigrationError, NotFound, SchemaMismatch
from millrace.functions.hashes import city64
from millrace.operators import dml, modifiers, relational
from millrace.plans.query import Query, desc, find
from millrace.sources import external, raw, tables
from millrace.sources.tables import SEQUENCE, Catalog, TableDef
from millrace.streaming import events, sinks


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_filter_replaces_and_and_filter_adds(spark):
    q = Query(spark.range(10)).filter(F.col("id") < 3).filter(F.col("id") > 6).and_filter(F.col("id") < 9)
    assert rows(q.to_df(spark)) == [(7,), (8,)]
    assert q.limit(1).first(spark).id in (7, 8)
    with pytest.raises(NotFound):
        q.filter(F.lit(False)).first(spark)
    assert q.filter(F.lit(False)).first_or(spark, "none") == "none"


def test_clause_order_does_not_matter(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 2), (2, "c", 1)], "k int, s string, v int")
    a = Query(df).limit_by(1, "k").order_by("v").select("k", "s")
    b = Query(df).select("k", "s").order_by("v").limit_by(1, "k")
    assert rows(a.to_df(spark)) == rows(b.to_df(spark)) == [(1, "b"), (2, "c")]


def test_totals_are_not_cut_by_limit_or_having(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), ("c", 1)], "k string, v int")
    q = Query(df).group_by("k").select("k", F.sum("v").alias("s")).with_totals()
    assert rows(q.to_df(spark)) == [("a", 3, False), ("c", 1, False), (None, 5, False), (None, 9, True)]
    assert (None, 9, True) in rows(q.having(F.col("s") > 4).to_df(spark))
    with pytest.raises(InvalidQuery):
        Query(df).group_by("k").to_df(spark)


def test_final_engines(spark):
    df = spark.createDataFrame([(1, 1, 100, 1), (1, 2, 200, 2), (2, 1, 5, 3), (2, 1, 6, 4)], f"k int, v int, x int, {SEQUENCE} long")
    assert rows(modifiers.final(df, tables.replacing("v"), "k").select("k", "x")) == [(1, 200), (2, 6)]
    assert rows(modifiers.final(df.drop(SEQUENCE), tables.summing("x"), "k").select("k", "x")) == [(1, 300), (2, 11)]
    signs = spark.createDataFrame([(1, 1, 1), (1, -1, 2), (2, 1, 3), (2, -1, 4), (2, 1, 5)], f"k int, s int, {SEQUENCE} long")
    assert rows(modifiers.final(signs, tables.collapsing("s"), "k")) == [(2, 1, 5)]
    assert modifiers.final(df, tables.merge_tree(), "k").count() == 4


def test_array_join(spark):
    df = spark.createDataFrame([(1, [1, 2], ["a", "b"]), (2, [], []), (3, None, None)], "k int, a array<int>, b array<string>")
    assert rows(modifiers.array_join(df, ["a", "b"])) == [(1, 1, "a"), (1, 2, "b")]
    assert rows(modifiers.array_join(df.drop("b"), "a", left=True, default_fill=True)) == [(1, 1), (1, 2), (2, 0), (3, 0)]
    odd = spark.createDataFrame([(1, [1], ["a", "b"])], df.schema)
    with pytest.raises(Exception, match="different lengths"):
        modifiers.array_join(odd, ["a", "b"]).collect()


def test_sample_is_the_same_in_any_layout(spark):
    a = rows(modifiers.sample(spark.range(1000), 0.2, "id", 0.3))
    assert a == rows(modifiers.sample(spark.range(1000).repartition(7), 0.2, "id", 0.3)) and 120 < len(a) < 280
    with pytest.raises(InvalidQuery):
        modifiers.sample(spark.range(1), 2, "id")


def test_limit_and_distinct_on_ties_and_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, None)], "k int, v int")
    assert rows(Query(df).distinct_on("k").order_by("v").to_df(spark)) == [(1, 3), (None, 1)]
    assert rows(modifiers.limit_by(df, 1, "k", [desc("v")])) == [(1, 3), (None, 2)]


def test_sum_with_overflow_and_weighted_mean(spark):
    top = 2**63 - 1
    df = spark.createDataFrame([(top, 1.0, 1.0), (1, None, 5.0)], "x long, v double, w double")
    assert df.agg(fn.sum_with_overflow("x")).first()[0] == -(2**63)
    assert df.agg(fn.avg_weighted("v", "w")).first()[0] == 1.0
    assert df.filter("false").agg(fn.avg_weighted("v", "w")).first()[0] is None


def test_hashes(spark):
    import xxhash

    assert city64(b"") == 0x9AE16A3B2F90404F
    texts = ["", "a", "abcd", "twelve chars", "x" * 25, "y" * 60, "z" * 200, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(fn.city_hash_64("t"), fn.xx_hash_64("t"), fn.xx_hash_64("t", 42)).collect()
    for t, (city, zero, other) in zip(texts, got):
        assert (city, zero, other) == (None, None, None) if t is None else (int(city), int(zero), int(other)) == (city64(t.encode()), xxhash.xxh64_intdigest(t, 0), xxhash.xxh64_intdigest(t, 42))
    assert len({g[0] for g in got}) == len(texts)


def test_date_diff_counts_boundaries(spark):
    df = spark.createDataFrame([(datetime.datetime(2023, 12, 31, 23), datetime.datetime(2024, 1, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert list(df.select(*[fn.date_diff(u, "a", "b") for u in ("day", "month", "year", "hour", "week")]).first()) == [1, 1, 1, 2, 1]


def test_dml_and_inserts(spark, tmp_path):
    t = TableDef.of("kv", {"k": "Int64", "v": "Nullable(String)"}, "k", engine=tables.replacing(), path=str(tmp_path / "kv"))
    assert dml.insert(spark, t, []) == 0
    dml.insert(spark, t, [(1, "a"), (2, None)])
    with sinks.AsyncInserter(spark, t) as out:
        out.write({"k": 1, "v": "b"})
        assert out.buffered_count == 1
    assert rows(Query(t).final_().to_df(spark)) == [(1, "b"), (2, None)]
    dml.update(spark, t, {"v": "z"}, F.col("v") == "b")
    assert find(spark, t, 2).v is None
    dml.delete(spark, t, F.col("v") == "z")
    assert rows(t.scan(spark).select("k", "v")) == [(1, "a"), (2, None)]
    with pytest.raises(InvalidQuery):
        dml.delete(spark, t)
    with pytest.raises(NotFound):
        find(spark, t, 99)


def test_a_failed_flush_keeps_its_rows(spark, tmp_path):
    t = TableDef.of("f", {"k": "Int64"}, "k", path=str(tmp_path / "f"))
    out = sinks.AsyncInserter(spark, t)
    out.write(("no number",))
    with pytest.raises(Exception):
        out.flush()
    assert out.buffered_count == 1


def test_formats_and_cursors(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string").coalesce(1)
    assert sinks.render(df, "JSONEachRow") == '{"k":1,"s":"a"}\n{"k":2,"s":null}\n'
    assert '"rows": 2' in sinks.render(df, "JSON") and sinks.render(df, "TabSeparated") == "1\ta\n2\t\\N\n"
    assert sinks.render(df, "ArrowStream")
    for name in ("JSONEachRow", "CSV", "TabSeparated", "Native", "ORC"):
        sinks.write_format(df, name, str(tmp_path / name))
    assert spark.read.parquet(str(tmp_path / "Native")).count() == 2
    seen = []
    assert sinks.zero_copy(df, lambda v: seen.append((v.get("k"), v.is_null("s")))) == 2 and seen == [(1, False), (2, True)]
    assert [r.k for r in sinks.RowStream(df)] == [1, 2] and sinks.RowStream(df).next().k == 1
    with pytest.raises(InvalidQuery):
        sinks.render(df, "XML")


def test_migrations_and_cli(spark, tmp_path):
    for name, up, down in (("001_one", "CREATE TABLE mig_a (x INT) USING parquet; -- a; b\nINSERT INTO mig_a VALUES (1)", "DROP TABLE mig_a"), ("002_two", "INSERT INTO mig_a SELECT 2 WHERE ';' = ';'", None)):
        (tmp_path / "m" / name).mkdir(parents=True)
        (tmp_path / "m" / name / "up.sql").write_text(up)
        if down:
            (tmp_path / "m" / name / "down.sql").write_text(down)
    base = ["--migrations", str(tmp_path / "m"), "--tracking", str(tmp_path / "t")]
    out = io.StringIO()
    assert cli.main([*base, "migration", "run", "--to", "1"], spark, out) == 0
    cli.main([*base, "migration", "list"], spark, out)
    assert out.getvalue() == "1\n[x] 1 one\n[ ] 2 two\n"
    cli.main([*base, "migration", "run"], spark, out)
    assert sorted(r.x for r in spark.table("mig_a").collect()) == [1, 2]
    with pytest.raises(MigrationError):
        cli.main([*base, "migration", "revert"], spark, out)
    (tmp_path / "m" / "002_two" / "up.sql").write_text("SELECT 1")
    with pytest.raises(MigrationError):
        cli.main([*base, "migration", "run"], spark, out)
    assert "mig_a" in Catalog(spark).tables() and "TableDef.of('mig_a'" in Catalog(spark).print_schema()
    spark.sql("DROP TABLE mig_a")
    with pytest.raises(MigrationError):
        migrations.combined([migrations.Migration(1, "a")], [migrations.Migration(1, "b")])


def test_event_windows_stream(spark, tmp_path):
    df = spark.createDataFrame([(datetime.datetime(2024, 1, 1, 0, m), m) for m in (0, 1, 2, 30)], "ts timestamp, v int")
    assert rows(events.tumbling(df, "ts", "10 minutes", [F.count("v").alias("n")]).select("n")) == [(1,), (3,)]
    assert rows(events.sessions(df, "ts", "5 minutes", [F.count("v").alias("n")]).select("n")) == [(1,), (3,)]
    df.write.parquet(str(tmp_path / "in"))
    stream = events.tumbling(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "ts", "10 minutes", [F.count("v").alias("n")], late="1 minute")
    q = stream.writeStream.format("memory").queryName("win").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("win").select("n")) == [(1,), (3,)]


def test_group_by_gives_the_selected_columns(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "k string, v int")
    q = Query(df).group_by("k")
    assert q.select(F.sum("v").alias("s")).to_df(spark).columns == ["s"]
    both = q.select(F.sum("v").alias("s"), "k").order_by(desc("k"))
    assert both.to_df(spark).columns == ["s", "k"] and [tuple(r) for r in both.load(spark)] == [(2, "b"), (4, "a")]
    assert rows(q.select("k").to_df(spark)) == [("a",), ("b",)]
    hidden = q.select(F.sum("v").alias("s")).order_by("k").limit(1)
    assert rows(hidden.to_df(spark)) == [(4,)]
    assert rows(Query(df).group_by("k", "v").select("k").distinct().to_df(spark)) == [("a",), ("b",)]


def test_totals_stand_beside_limit_and_offset(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), ("c", 1)], "k string, v int")
    q = Query(df).group_by("k").with_totals().select(F.sum("v").alias("s"), "k").order_by("k")
    assert [tuple(r) for r in q.limit(1).load(spark)] == [(3, "a", False), (9, None, True)]
    assert [tuple(r) for r in q.offset(2).load(spark)] == [(5, None, False), (9, None, True)]
    assert [tuple(r) for r in q.having(F.col("s") > 100).load(spark)] == [(9, None, True)]
    assert [tuple(r) for r in q.order_by(desc("s")).limit(2).load(spark)] == [(5, None, False), (3, "a", False), (9, None, True)]
    assert [tuple(r) for r in q.select(F.sum("v").alias("s")).order_by("k").limit(2).load(spark)] == [(3, False), (1, False), (9, True)]


def test_settings_hold_on_every_way_to_a_result(spark):
    q = Query(spark.range(4)).settings(max_threads=3)
    key, seen = "spark.sql.shuffle.partitions", []
    assert q.run(spark, lambda df: spark.conf.get(key)) == "3" and spark.conf.get(key) == "4"
    for row in q.stream(spark):
        seen.append((row.id, spark.conf.get(key)))
    assert sorted(seen) == [(i, "3") for i in range(4)] and q.load_arrow(spark).num_rows == 4 and spark.conf.get(key) == "4"


def test_not_in_has_three_values_and_no_broadcast(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for sub, want in (([], [(1,), (2,), (None,)]), ([(1,)], [(2,)]), ([(1,), (None,)], [])):
            out = relational.not_in_subquery(df, "k", spark.createDataFrame(sub, "k int"))
            assert rows(out) == want and "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_named_queries_leave_text_and_session_alone(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    views = len(spark.catalog.listTables())
    assert rows(relational.with_queries(spark, "SELECT 'from a, {a}' AS t, a.k FROM a, b WHERE a.k = b.k", a=a, b=a)) == [("from a, {a}", 1)]
    assert rows(relational.with_queries(spark, "WITH c AS (SELECT k + 1 AS k FROM a) SELECT k FROM c", a=a)) == [(2,)]
    assert len(spark.catalog.listTables()) == views


def test_raw_sql(spark):
    df = spark.createDataFrame([(1, "O'Brien"), (2, "x")], "k int, s string")
    assert raw.load_one_bound(spark, "SELECT k FROM {t} WHERE s = ?", "O'Brien", t=df).k == 1
    assert raw.load_optional_bound(spark, "SELECT k FROM {t} WHERE s = ?", "' OR 1 = 1 --", t=df) is None
    with pytest.raises(NotFound):
        raw.load_one_bound(spark, "SELECT k FROM {t} WHERE k = ?", 9, t=df)
    with pytest.raises(InvalidQuery):
        raw.load_one_bound(spark, "SELECT k FROM {t}", t=df)
    assert raw.ping(spark) and len(raw.load_raw(spark, "SELECT * FROM {t}", t=df)) == 2
    assert df.select(raw.sql("Float64", "k / 2").alias("h")).dtypes == [("h", "double")]
    raw.execute(spark, "CREATE TABLE raw_t (x INT) USING parquet")
    raw.execute_bound(spark, "INSERT INTO raw_t SELECT ?", 5)
    assert rows(spark.table("raw_t")) == [(5,)]
    raw.execute(spark, "DROP TABLE raw_t")


def test_ranks_over_a_whole_frame_and_ties(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.choice([None, *range(40)]), i) for i in range(500)], "v int, i int")
    want = rows(df.select("i", F.rank().over(Window.orderBy("v")).alias("r")))
    assert rows(modifiers.ranked(df, "v", share=30).select("i", "_rank")) == want
    assert rows(modifiers.ranked(df.limit(0), "v").select("i")) == []
    for n in (0, 1, 7, 499, 600):
        for order in ([F.col("v").desc_nulls_last()], [F.col("v").asc_nulls_first(), F.col("i").desc()], [F.col("v").asc_nulls_last()]):
            ties = df.withColumn("r", F.rank().over(Window.orderBy(*order))).filter(F.col("r") <= n).drop("r")
            assert rows(modifiers.limit_with_ties(df, n, order)) == rows(ties)


def test_floor_and_ceil_keep_the_type(spark):
    df = spark.createDataFrame([(-1.5, 3, -1e-20), (math.inf, -2, 2.0), (2.0**60, 1, 0.25), (None, None, None)], "a double, b smallint, c double")
    out = df.select(*[f(c).alias(n + c) for n, f in (("f", fn.floor), ("c", fn.ceil)) for c in "abc"])
    assert [t for _, t in out.dtypes] == ["double", "smallint", "double"] * 2
    assert [tuple(r) for r in out.collect()] == [(-2.0, 3, -1.0, -1.0, 3, 0.0), (math.inf, -2, 2.0, math.inf, -2, 2.0), (2.0**60, 1, 0.0, 2.0**60, 1, 1.0), (None,) * 6]


def test_quantiles_by_sketch_and_exactly(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    assert df.agg(fn.quantile(0.9, "v"), fn.median("v"), fn.quantile_exact(0.25, "v"), fn.median_exact("v")).first()[:] == (900.0, 500.0, 250.0, 500.0)


def test_inserts_flush_by_age_size_and_in_the_background(spark, tmp_path):
    t = TableDef.of("g", {"k": "Int64", "s": "String"}, "k", path=str(tmp_path / "g"))
    with sinks.AsyncInserter(spark, t, sinks.InsertConfig(busy_timeout_ms=100)) as out:
        out.write((1, "a"))
        for _ in range(100):
            if out.sent_count:
                break
            time.sleep(0.1)
        assert out.sent_count == 1 and out.buffered_count == 0
    with sinks.AsyncInserter(spark, t, sinks.InsertConfig(max_bytes=20)) as out:
        out.write((2, "x" * 30))
        assert out.sent_count == 1
    with sinks.AsyncInserter(spark, t, sinks.InsertConfig.fire_and_forget()) as out:
        out.write((3, "b"))
        assert out.flush() == 0
        out.flush_all()
        assert out.sent_count == 1
    assert rows(t.scan(spark).select("k")) == [(1,), (2,), (3,)]
    out = sinks.AsyncInserter(spark, t, sinks.InsertConfig(wait=False))
    out.write(("no number", "c"))
    with pytest.raises(Exception):
        out.flush_all()
    assert out.buffered_count == 1


def test_an_inserted_frame_runs_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    t = TableDef.of("o", {"id": "Int64"}, "id", path=str(tmp_path / "o"))
    assert dml.insert(spark, t, spark.range(7).mapInArrow(count, "id long")) == 7 and runs.value == 7


def test_arrow_comes_in_batches(spark):
    df = spark.range(0, 2500, 1, 3)
    sizes = [b.num_rows for b in sinks.arrow_batches(df, 500)]
    assert sum(sizes) == 2500 and max(sizes) <= 500 and len(sizes) >= 6
    assert list(sinks.arrow_batches(df.limit(0))) == []
    with pytest.raises(SchemaMismatch):
        sinks.zero_copy(df, lambda v: v.get("id", str))
    with pytest.raises(InvalidQuery):
        sinks.render(df, "JSON", most=100)


def test_reset_runs_the_migrations_again(spark, tmp_path):
    (tmp_path / "m" / "1_a").mkdir(parents=True)
    (tmp_path / "m" / "1_a" / "up.sql").write_text("CREATE TABLE reset_a (x INT) USING parquet")
    base = ["--database", "reset_db", "--migrations", str(tmp_path / "m"), "--tracking", str(tmp_path / "t")]
    out = io.StringIO()
    try:
        cli.main([*base, "database", "reset"], spark, out)
        cli.main([*base, "database", "reset"], spark, out)
        assert out.getvalue() == "1\n1\n" and Catalog(spark, "reset_db").tables() == ["reset_a"]
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE IF EXISTS reset_db CASCADE")
    own = migrations.embedded({"2_b": ("SELECT 2", "SELECT 0"), "1_a": "SELECT 1"})
    assert [(m.version, m.name, m.down) for m in own] == [(1, "a", None), (2, "b", "SELECT 0")]


def test_definitions_come_back_from_the_catalog(spark, tmp_path):
    t = TableDef.of("kept_t", {"id": "UInt64", "at": "DateTime('UTC')", "v": "Enum8('it''s' = 1)", "j": "JSON"}, ("id", "at"), engine=tables.replacing("id"), sample_by="id")
    spark.sql(t.ddl())
    try:
        found = Catalog(spark)
        assert found.definition("kept_t") == t and [k for *_, k in found.columns("kept_t")] == [True, True, False, False]
        assert "engine=Engine('ReplacingMergeTree', ('id',))" in found.print_schema(only=["kept_t"])
    finally:
        spark.sql("DROP TABLE kept_t")
    m = TableDef.of("m", {"k": "Int64", "j": "JSON"}, "k", engine=tables.memory(), path=str(tmp_path / "m"))
    dml.insert(spark, m, [(1, '{"a": {"b": 5}}'), (2, "no")])
    assert m.scan(spark).storageLevel.useMemory
    assert rows(m.variants(spark).select("k", F.try_variant_get("j", "$.a.b", "int"))) == [(1, 5), (2, None)]


def test_literals_and_names_are_escaped(spark):
    for value in ("O'Brien", "a\\\\b", "x' OR '1'='1", "`", "%_", "é\n"):
        assert spark.sql(f"SELECT {tables.literal(value)} AS x").first().x == value
        assert spark.sql(f"SELECT 1 AS {tables.quoted(value)}").columns == [value]
    when = datetime.datetime(2024, 2, 29, 1, 2, 3)
    assert spark.sql(f"SELECT {tables.literal([1, 2])} AS a, {tables.literal(when)} AS t, {tables.literal(when.date())} AS d, {tables.literal(None)} AS n, {tables.literal(True)} AS b").first()[:] == ([1, 2], when, when.date(), None, True)


def test_create_table_texts_are_translated(spark):
    text = "CREATE TABLE IF NOT EXISTS tr_a (\n id UInt64,\n `name` String CODEC(ZSTD(1)),\n tags Array(String),\n ok Bool DEFAULT true,\n at DateTime DEFAULT now()\n) ENGINE = ReplacingMergeTree(at)\nPARTITION BY toYYYYMM(at) ORDER BY (id, at) SETTINGS index_granularity = 8192"
    spark.sql(migrations.translated(text))
    try:
        t = Catalog(spark).definition("tr_a")
        assert t.key == ("id", "at") and t.engine == tables.replacing("at") and t.columns[2] == ("tags", "Array(String)")
        spark.sql("INSERT INTO tr_a (id, name, tags) VALUES (1, 'x', array('a'))")
        assert [(r.id, r.ok, r.at is not None) for r in spark.table("tr_a").collect()] == [(1, True, True)]
    finally:
        spark.sql("DROP TABLE tr_a")
    assert migrations.translated("SELECT ';'") == "SELECT ';'"
    with pytest.raises(MigrationError):
        migrations.translated("CREATE TABLE t (a Int8 DEFAULT rand()) ENGINE = Log")


def test_asof_and_range_joins(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "b", 9), (4, None, 9), (5, "a", None)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 2, 20), ("a", 5, 50), ("a", 6, 60), ("b", None, 0), (None, 1, 1)], "k string, t int, v int")
    assert rows(relational.asof_join(left, right, "t", ["k"], ["v"]).select("id", "v")) == [(1, 50), (2, None), (3, None), (4, None), (5, None)]
    assert rows(relational.asof_join(left, right, "t", ["k"], ["v"], inner=True)) == [(1, "a", 5, 50)]
    rng = random.Random(3)
    points = [(i, rng.uniform(-50, 50)) for i in range(80)]
    spans = [(j, a, a + rng.choice([0.0, 0.5, 7.0, 40.0])) for j in range(40) for a in [rng.uniform(-50, 50)]]
    got = relational.range_join(spark.createDataFrame(points, "i int, x double"), spark.createDataFrame(spans, "j int, lo double, hi double"), "x", "lo", "hi", 5)
    assert rows(got.select("i", "j")) == sorted(((i, j) for i, x in points for j, a, b in spans if a <= x < b), key=str)


def test_external_files(spark, tmp_path):
    t = TableDef.of("t", {"k": "Nullable(Int64)", "s": "Nullable(String)"}, "k")
    df = spark.createDataFrame([(1, "a"), (2, None)], "k long, s string")
    for name in external.READERS:
        sinks.write_format(df, name, str(tmp_path / name))
        assert rows(external.files(spark, t, name, str(tmp_path / name))) == [(1, "a"), (2, None)]
    (tmp_path / "odd.csv").write_text("x,y\n3,z\n")
    assert rows(external.files(spark, t, "CSV", str(tmp_path / "odd.csv"), strict=False)) == [(3, "z"), (None, "y")]
    with pytest.raises(Exception):
        external.files(spark, t, "CSV", str(tmp_path / "odd.csv")).collect()
    with pytest.raises(InvalidQuery):
        external.files(spark, t, "XML", "x")
