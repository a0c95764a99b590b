"""Raw files: odd encodings, split columns, contracts, partitions, reloads."""

import datetime as dt
import gzip
import random

import pytest
from pyspark.sql import functions as F

from mercatura.sources import quoted_csv, raw_csv, tables
from mercatura.sources.contracts import CONTRACTS, Contract
from mercatura.sources.seeds import load_translation

SMALL = Contract(
    {"id": "varchar(3)", "n": "int", "at": "timestamp_ntz", "price": "decimal(10,2)"},
    required="id",
    partition_by="at",
    sort_key="id",
)


@pytest.fixture
def folder(tmp_path):
    def write(name, *files):
        target = tmp_path / name
        target.mkdir()
        for number, content in enumerate(files):
            (target / f"part{number}.csv").write_bytes(content)
        return str(target)

    return write


def test_bom_crlf_and_quotes(spark, folder):
    path = folder("t", '﻿a,b\r\n"x, ""y""",1\r\n,2\r\n'.encode())
    df = raw_csv.read_csv(spark, path)
    assert df.columns == ["a", "b"] and set(dict(df.dtypes).values()) == {"string"}
    assert [tuple(r) for r in df.collect()] == [('x, "y"', "1"), (None, "2")]


def test_quoted_line_breaks_with_bom_in_every_file(spark, folder):
    files = ['﻿a,b\r\n"one\r\ntwo",1\r\n'.encode(), '﻿a,b\r\n"three\nfour",2\r\n'.encode()]
    df = raw_csv.read_csv(spark, folder("t", *files), multiline=True)
    assert df.columns == ["a", "b"]
    rows = {r.b: r.a.replace("\r\n", "\n") for r in df.collect()}
    assert rows == {"1": "one\ntwo", "2": "three\nfour"}


def test_seed_file(spark, folder):
    lines = "\r\n".join(
        ["product_category_name,product_category_name_english", "musica,music", "artes,art"]
    )
    seed = load_translation(spark, folder("seed", ("﻿" + lines + "\r\n").encode()))
    assert {tuple(r) for r in seed.collect()} == {("musica", "music"), ("artes", "art")}


def test_empty_source_fails(spark, folder):
    path = folder("t", b"a,b\n")
    with pytest.raises(RuntimeError, match="no rows"):
        raw_csv.require_rows(raw_csv.read_csv(spark, path), path)


def test_drift_adds_nulls(spark):
    old = spark.createDataFrame([("1",)], "a string")
    new = spark.createDataFrame([("2", "x")], "a string, b string")
    merged = raw_csv.merge_drift([old, new])
    assert {tuple(r) for r in merged.collect()} == {("1", None), ("2", "x")}


def test_split_columns_are_put_together_and_real_names_stay(spark):
    df = spark.createDataFrame(
        [("1", None, 5, "l"), (None, 2.5, None, "l")],
        "id_string string, price_double double, price_long int, lead_int string",
    )
    repaired = raw_csv.repair_columns(df, SMALL)
    assert repaired.columns == ["id", "price", "lead_int"]
    assert [tuple(r) for r in repaired.collect()] == [("1", "5", "l"), (None, "2.5", "l")]


def test_plain_column_wins_over_its_variant(spark):
    df = spark.createDataFrame([("a", "b"), (None, "c")], "id string, id_string string")
    repaired = raw_csv.repair_columns(df, SMALL)
    assert repaired.columns == ["id"] and [r.id for r in repaired.collect()] == ["a", "c"]


def test_all_null_columns(spark):
    df = spark.createDataFrame([("1", None)], "a string, b string")
    left, dropped = raw_csv.drop_all_null(df)
    assert (left.columns, dropped) == (["a"], ["b"])


def test_partition_columns_with_fallbacks(spark):
    rows = [("2018-03-04 05:06:07",), ("2018-03-04",), ("soon",), (None,)]
    df = spark.createDataFrame(rows, "at_string string")
    found = raw_csv.add_partition_columns(df, "at")
    parts = [(r.partition_year, r.partition_month) for r in found.collect()]
    assert parts == [("2018", "03"), ("2018", "03"), (None, None), (None, None)]
    assert raw_csv.drop_partition_columns(found).columns == ["at_string"]
    with pytest.raises(ValueError, match="cannot partition"):
        raw_csv.add_partition_columns(df, "other")


def test_timestamp_casts_count_only_present_values(spark):
    rows = [("soon", None), ("2018-01-02 03:04:05", "n/a")]
    df = spark.createDataFrame(rows, "a string, b string")
    counts = raw_csv.timestamp_failures(df, ["a", "b", "absent"])
    assert {r.column_name: r.unparsed_rows for r in counts.collect()} == {"a": 1, "b": 1}
    cast = raw_csv.cast_timestamps(df, ["a", "absent"])
    assert [r.a for r in cast.collect()] == [None, dt.datetime(2018, 1, 2, 3, 4, 5)]


def test_contract_orders_types_drops_and_reports(spark):
    df = spark.createDataFrame(
        [("x", "1.50", "7", "1")], "extra string, price string, n string, id string"
    )
    with pytest.raises(ValueError, match=r"missing: \['at'\]"):
        raw_csv.apply_contract(df, SMALL)
    typed = raw_csv.apply_contract(df, SMALL, all_null=["at"])
    assert typed.dtypes == [
        ("id", "string"), ("n", "int"), ("at", "timestamp_ntz"), ("price", "decimal(10,2)"),
    ]
    assert typed.first().at is None


def test_contract_violations(spark):
    df = spark.createDataFrame([("1234",), (None,), ("1",)], "id string")
    found = {r.violation: r.row_count for r in raw_csv.contract_violations(df, SMALL).collect()}
    assert found == {"id is longer than 3": 1, "id is null": 1}


def test_a_value_of_the_wrong_type_stops_the_load(spark):
    df = spark.createDataFrame([("many",)], "n string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        raw_csv.apply_contract(df, Contract({"n": "int"})).collect()


RAW = b"id,n,at,price,note\na,1,2018-03-04 05:06:07,1.50,\nb,2,soon,2.50,\nc,,2018-04-01,,\n"


def test_csv_to_table_and_back(spark, folder, tmp_path):
    processed, target = str(tmp_path / "processed"), str(tmp_path / "target")
    step = tables.csv_to_parquet(spark, folder("raw", RAW), processed, SMALL)
    assert step == (3, ["note"], 0)
    assert tables.read_partitions(spark, processed, "2018", "03").count() == 1
    assert tables.reload_table(spark, processed, target, SMALL, step.all_null) == 3
    rows = {r.id: (r.n, r.at, r.price) for r in tables.read_table(spark, target).collect()}
    assert rows["b"][:2] == (2, None) and rows["c"] == (None, dt.datetime(2018, 4, 1), None)
    # A second run replaces, it does not append.
    tables.csv_to_parquet(spark, str(tmp_path / "raw"), processed, SMALL)
    assert tables.reload_table(spark, processed, target, SMALL, step.all_null) == 3


def test_partition_predicate_prunes(spark, folder, tmp_path):
    processed = str(tmp_path / "processed")
    tables.csv_to_parquet(spark, folder("raw", RAW), processed, SMALL)
    month = tables.read_partitions(spark, processed, "2018", "03")
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_year" in plan


def test_reconcile(spark):
    df = spark.range(3)
    assert tables.reconcile(3, df, "t") == 3
    with pytest.raises(tables.RowCountMismatch, match="4 rows sent, 3 arrived"):
        tables.reconcile(4, df, "t")


def test_one_bad_table_does_not_stop_the_others(spark):
    def load(name):
        if name == "bad":
            raise ValueError("broken")
        return len(name)

    with pytest.raises(tables.LoadFailed, match="bad") as failed:
        tables.run_tables(spark, load, ["one", "bad", "three"])
    rows = {r.table_name: (r.rows, r.status, r.error) for r in failed.value.summary.collect()}
    assert rows == {
        "one": (3, "loaded", None),
        "bad": (None, "failed", "ValueError: broken"),
        "three": (5, "loaded", None),
    }


def test_every_contract_type_is_known(spark):
    for name, contract in CONTRACTS.items():
        schema = ", ".join(f"{c} {contract.spark_type(c)}" for c in contract.columns)
        empty = spark.createDataFrame([], schema)
        assert raw_csv.apply_contract(empty, contract).columns == list(contract.columns), name
        assert raw_csv.contract_violations(empty, contract).where(F.col("row_count") > 0).isEmpty()


def test_files_are_read_by_their_own_header(spark, folder, tmp_path):
    files = [b"id,n,at,price\na,1,2018-01-02,1.5\n", b"id,price,at,n,more\nb,2.5,2018-02-03,2,x\n"]
    path = folder("mixed", *files, b"id,n,price\nc,3,3.5\n")
    rows = {r.id: (r.n, r.price, r.at, r.more) for r in raw_csv.read_csv(spark, path).collect()}
    assert rows == {
        "a": ("1", "1.5", "2018-01-02", None),
        "b": ("2", "2.5", "2018-02-03", "x"),
        "c": ("3", "3.5", None, None),
    }


def test_malformed_rows_are_counted_and_refused(spark, folder, tmp_path):
    content = b"id,n,at,price\na,1,2018-01-02,1.5\nb,2\nc,3,2018-01-02,2.5,extra\n"
    raw, target = folder("raw", content), str(tmp_path / "processed")
    with pytest.raises(tables.MalformedRows, match="2 rows"):
        tables.csv_to_parquet(spark, raw, target, SMALL)
    assert not (tmp_path / "processed").exists()
    step = tables.csv_to_parquet(spark, raw, target, SMALL, allow_malformed=2)
    assert step == (3, [], 2)


def test_broken_contract_leaves_the_old_table(spark, tmp_path):
    source, target = str(tmp_path / "processed"), str(tmp_path / "target")
    good = [("a", "1", "2018-01-02 03:04:05", "1.5")]
    schema = "id string, n string, at string, price string"
    spark.createDataFrame(good, schema).write.parquet(source)
    assert tables.reload_table(spark, source, target, SMALL) == 1
    bad = [("long id", "1", None, None), (None, "2", None, None)]
    spark.createDataFrame(bad, schema).write.mode("overwrite").parquet(source)
    with pytest.raises(tables.ContractBroken, match="id is longer than 3: 1 rows; id is null: 1 rows"):
        tables.reload_table(spark, source, target, SMALL, ["at", "price"])
    assert [r.id for r in spark.read.parquet(target).collect()] == ["a"]


def test_a_write_that_fails_half_way_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    broken = spark.range(100).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        tables.write_table(spark.range(50).union(broken), path)
    assert spark.read.parquet(path).count() == 5
    assert [f.name for f in tmp_path.iterdir()] == ["t"]
    (tmp_path / "t").rename(tmp_path / "t.before")  # as after a crash between the two renames
    assert tables.read_table(spark, path).count() == 5


def test_numeric_variants_and_session_zones(spark):
    rows = [("1", 4.0, None), ("2", 4.5, None), ("3", None, 7)]
    split = spark.createDataFrame(rows, "id string, n_double double, n_long long")
    repaired = raw_csv.repair_columns(split, SMALL)
    assert [r.n for r in repaired.collect()] == ["4", "4.5", "7"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        text = spark.createDataFrame([("2017-10-15 00:30:00",)], "at string")
        assert raw_csv.cast_timestamps(text, ["at"]).first().at == dt.datetime(2017, 10, 15, 0, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def quoted_file(count, ending="\n"):
    """Records with line breaks, doubled quotes, separators and empty lines inside quotes."""
    rng = random.Random(count)
    lines = ["a,b,c"]
    for i in range(count):
        inner = rng.choice(["plain", "two\nlines", "a\n\n\nb", 'said ""no""', '""', "x,y", "\n", "," * 3, "é\nü" * 30])
        field = inner if inner == "plain" else f'"{inner}"'
        lines.append(rng.choice([f"{i},{field},end", f'{i},{field},"last\n{i}"', f"{i},,{field}"]))
    return (ending.join(lines) + ending).encode()


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("block", [40, 333, 5_000, 1_000_000])
def test_quoted_files_in_blocks_equal_whole_files(spark, folder, ending, block):
    path = folder("t", quoted_file(150, ending), quoted_file(70, ending), b"a,b,c" + ending.encode())
    whole = raw_csv.read_files(spark, path, multiline=True)
    split = raw_csv.read_files(spark, path, multiline=True, split_above=0, block_bytes=block)
    assert split.columns == whole.columns
    assert rows_of(split) == rows_of(whole) and split.count() == 220


def test_one_file_is_read_by_several_tasks(spark, folder, monkeypatch):
    path, staged, stage = folder("t", quoted_file(400)), {}, quoted_csv.stage
    monkeypatch.setattr(quoted_csv, "stage", lambda df, label: staged.setdefault(label, stage(df, label)))
    raw_csv.read_files(spark, path, multiline=True, split_above=0, block_bytes=2_000)
    assert staged["lines"].select("block").distinct().count() >= 4
    assert staged["blocks"].where("inside = 1").count() >= 1


def test_malformed_rows_and_odd_quotes_in_split_files(spark, folder):
    bad = b'a,b,c\n1,"x\ny"\n2,"x\ny",z,w\n3,x,"y\n"\n'
    path = folder("t", bad)
    split = raw_csv.read_files(spark, path, multiline=True, split_above=0, block_bytes=10)
    whole = raw_csv.read_files(spark, path, multiline=True)
    marked = [r.a for r in split.collect() if r[raw_csv.MALFORMED] is not None]
    assert sorted(marked) == ["1", "2"]
    assert rows_of(split.drop(raw_csv.MALFORMED)) == rows_of(whole.drop(raw_csv.MALFORMED))
    odd = folder("o", b'a,b\n1,5" pipe\n2,"x\ny"\n3,z\n', quoted_file(5).replace(b"a,b,c", b"a,b"))
    plain = raw_csv.read_files(spark, odd, multiline=True)
    assert rows_of(raw_csv.read_files(spark, odd, multiline=True, split_above=0, block_bytes=9).select("a")) == rows_of(
        plain.select("a")
    )


def test_blank_first_lines_subfolders_and_compressed_files(spark, tmp_path):
    root = tmp_path / "t"
    (root / "sub" / "deep").mkdir(parents=True)
    (root / "_logs").mkdir()
    (root / "1.csv").write_bytes(b"a,b\n1,x\n")
    (root / "2.csv").write_bytes(b"\n\r\na,b\n2,x\n")
    (root / "sub" / "3.csv").write_bytes(b"b,a\nx,3\n")
    (root / "sub" / "deep" / "4.csv.gz").write_bytes(gzip.compress(b'a,b\n4,"x\n"\n'))
    (root / "_logs" / "5.csv").write_bytes(b"a,b\n5,x\n")
    for options in ({}, {"split_above": 0, "block_bytes": 3}):
        found = raw_csv.read_files(spark, str(root), multiline=True, **options)
        assert sorted(r.a for r in found.collect()) == ["1", "2", "3", "4"]
    (root / "empty.csv").write_bytes(b"\n\n")
    with pytest.raises(raw_csv.HeaderMissing, match="empty.csv"):
        raw_csv.read_files(spark, str(root))


def test_each_timestamp_of_a_reload_is_parsed_once(spark):
    rows = [("soon", None), ("2018-01-02 03:04:05", "n/a"), (None, "2018-01-02")]
    df = spark.createDataFrame(rows, "a string, b string")
    cast, seen = raw_csv.observed_timestamps(df, ["a", "b", "absent"])
    at = dt.datetime(2018, 1, 2, 3, 4, 5)
    assert [(r.a, r.b) for r in cast.select("a", "b").collect()] == [
        (None, None), (at, None), (None, dt.datetime(2018, 1, 2))
    ]
    assert seen.get == {"rows": 3, "unparsed_a": 1, "unparsed_b": 1}
    plan = cast._jdf.queryExecution().optimizedPlan().toString()
    counted = next(line for line in plan.splitlines() if "CollectMetrics" in line)
    assert "_unread_a" in counted and "timestamp_ntz" not in counted


def test_partitions_of_odd_years_are_those_of_the_formatter(spark):
    dates = ["2018-01-02 03:04:05", "0987-11-30", "0001-01-01", "0000-05-06", "-0044-03-15", "+12345-10-09", "soon", None]
    df = spark.createDataFrame([(d,) for d in dates], "at string")
    made = raw_csv.add_partition_columns(df, "at")
    parsed = raw_csv.parse_timestamp(F.col("at"))
    wanted = df.select("at", F.date_format(parsed, "yyyy"), F.date_format(parsed, "MM"))
    assert [tuple(r) for r in made.collect()] == [tuple(r) for r in wanted.collect()]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("date_format(") == 1
