"""Cleansing: tokens, numbers, timestamps, and the order of the steps."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.numbers import to_number
from twinledger.functions.text import contains_ignore_case, is_blank, strip_ws, time_of_day
from twinledger.functions.timestamps import normalize_iso8601
from twinledger.operators.cleanse import (
    cleanse_feed,
    cleanse_metrics,
    cleanse_trades,
    drop_blank_ids,
    drop_missing,
    keep_positive,
    cleanse_csv,
    coerce_numbers,
    out_of_range,
    rejects_by_rule,
    usable_trades,
    with_iso_timestamp,
)
from twinledger.operators import store as stores
from twinledger.schema import NULL_TOKENS, RAW_FEED, TRADE_COLUMNS, WHITESPACE
from twinledger.sources.feeds import (
    ARRIVAL,
    broken_lines,
    dataset_summary,
    read_arriving_csv,
    read_raw_csv,
    read_trades_csv,
    write_trades,
)

GOOD = ("T1", "AAPL", "150.50", "10", "B1", "S1", "2026-10-01T10:00:00Z")


def raw(spark, rows):
    columns = ", ".join(f"{c} string" for c in TRADE_COLUMNS) + ", seq int"
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], columns)


def but(**changes):
    return tuple(changes.get(c, v) for c, v in zip(TRADE_COLUMNS, GOOD))


def ids(df):
    return sorted(r.trade_id for r in df.collect())


def evaluated(spark, cases, expression):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, v string")
    rows = df.select("i", expression(F.col("v")).alias("v")).orderBy("i").collect()
    return [r.v for r in rows]


def one(spark, text, expression):
    return spark.createDataFrame([(text,)], "v string").select(expression(F.col("v"))).first()[0]


TIMESTAMPS = [
    ("2026-10-01T10:00:00Z", "2026-10-01T10:00:00Z"),
    ("2026-10-01 10:00:00", "2026-10-01T10:00:00Z"),
    ("2026-10-01T09:30:00+02:00", "2026-10-01T07:30:00Z"),
    ("2026-10-01", "2026-10-01T00:00:00Z"),
    ("2026-10-01T10:00:00.987654Z", "2026-10-01T10:00:00Z"),
    (" \t2026-10-01T10:00:00Z\n", "2026-10-01T10:00:00Z"),
    ("1790847000", "2026-10-01T09:30:00Z"),
    ("1790847000250", "2026-10-01T09:30:00Z"),
    ("100000000000", None),  # not above the threshold, so seconds: beyond the range
    ("100000000001", "1973-03-03T09:46:40Z"),  # above it, so milliseconds
    ("0", "1970-01-01T00:00:00Z"),
    ("99999999999999999999", None),
    ("10/01/2026 09:30", "2026-10-01T09:30:00Z"),
    ("10/01/2026", "2026-10-01T00:00:00Z"),
    ("Oct 1 2026", "2026-10-01T00:00:00Z"),
    ("Oct 1, 2026 09:30", "2026-10-01T09:30:00Z"),
    ("1 Oct 2026", "2026-10-01T00:00:00Z"),
    ("2026/10/01 09:30:05", "2026-10-01T09:30:05Z"),
    ("not-a-date", None),
    ("2026-13-45", None),
    ("2026-02-30", None),
    ("99/99/2026", None),
    ("now", None),
    ("10:00:00", None),
    ("-5", None),
    ("nan", None),
    ("None", None),
    ("", None),
    (None, None),
    ("9999-12-31", None),
    ("0001-01-01", None),
]


def test_timestamps(spark):
    assert evaluated(spark, TIMESTAMPS, normalize_iso8601) == [e for _, e in TIMESTAMPS]


NUMBERS = [
    ("12.5", 12.5),
    (" 12.5 ", 12.5),
    ("1e3", 1000.0),
    ("+5", 5.0),
    (".5", 0.5),
    ("5.", 5.0),
    ("-0.01", -0.01),
    ("10d", None),
    ("10f", None),
    ("1_000", None),
    ("abc", None),
    ("", None),
    ("inf", None),
    ("Infinity", None),
    ("nan", None),
    ("1e999", None),
    ("0x10", None),
    (None, None),
]


def test_numbers(spark):
    got = evaluated(spark, NUMBERS, to_number)
    assert [None if v is None else float(v) for v in got] == [e for _, e in NUMBERS]


def test_strip_takes_all_whitespace(spark):
    assert one(spark, WHITESPACE + "a b" + WHITESPACE, strip_ws) == "a b"
    assert one(spark, WHITESPACE, is_blank) is True
    assert one(spark, None, is_blank) is True
    assert one(spark, "​", is_blank) is False  # not whitespace


def test_strip_knows_what_needs_no_stripping(spark):
    odd = ["\u00a0", "\u3000", "\x1f", "\x7f", "~", "!", "é", "x", " "]
    texts = [""] + odd + [a + m + b for a in odd for b in odd for m in ("", "mid")]
    cases = [(t, t.strip(WHITESPACE)) for t in texts]
    assert evaluated(spark, cases, strip_ws) == [want for _, want in cases]


def test_one_layout_is_tried_for_a_shape(spark):
    zoo = [
        ("10/01/2026 09:30:15.250123", "2026-10-01T09:30:15Z"), ("10/01/2026 9:30:15 pm", "2026-10-01T21:30:15Z"),
        ("10-01-2026 9:30", "2026-10-01T09:30:00Z"), ("2026/1/5", "2026-01-05T00:00:00Z"), ("1 october 2026", "2026-10-01T00:00:00Z"),
        ("october 1, 2026 9:30 am", "2026-10-01T09:30:00Z"), ("1 May 2026 9:30", "2026-05-01T09:30:00Z"), ("10/01/2026 13:30 PM", None),
        ("10/01/20261", None), ("10/01/1676", None), ("10/01/2263", None), ("Octob 1 2026", None), ("10/01/02026", None),
    ]
    assert evaluated(spark, zoo, normalize_iso8601) == [want for _, want in zoo]


def test_a_timestamp_is_computed_once(spark):
    raw = spark.createDataFrame([("T", "10/01/2026")], "trade_id string, timestamp string")
    plan = drop_missing(with_iso_timestamp(raw), "timestamp")._jdf.queryExecution().optimizedPlan().toString()
    once = with_iso_timestamp(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("M-d-yyyy") == once.count("M-d-yyyy") == 1


def test_texts_in_normal_form_are_checked_all_the_same(spark):
    cases = [
        ("2024-02-29T23:59:59Z", "2024-02-29T23:59:59Z"), ("2023-02-29T00:00:00Z", None), ("2026-04-31T00:00:00Z", None),
        ("2026-12-31T00:00:00Z", "2026-12-31T00:00:00Z"), ("2026-01-01T24:00:00Z", None), ("1676-01-01T00:00:00Z", None),
        ("2026-01-01T00:00:00Z\n", "2026-01-01T00:00:00Z"), (" 2026-01-01T00:00:00Z", "2026-01-01T00:00:00Z"), (None, None),
    ]
    assert evaluated(spark, cases, normalize_iso8601) == [want for _, want in cases]


def test_no_step_is_too_long_to_be_compiled(spark, tmp_path, capsys):
    """The JVM never compiles a method of over 8,000 bytes: such a step runs many times slower."""
    raw = spark.createDataFrame([], T.StructType([*RAW_FEED.fields, T.StructField("at", T.LongType())]))
    write_trades(spark.createDataFrame([("T", "X", "1", "1", "B", "S", "2026-10-01")], RAW_FEED), str(tmp_path / "in"), "csv")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # all of the plan is shown
    try:
        usable = drop_missing(usable_trades(raw), "timestamp")
        loaded = stores.first_copies(stores.storable(cleanse_trades(raw, ["at"])))
        arriving = cleanse_trades(read_arriving_csv(spark, str(tmp_path / "in")), ARRIVAL)
        for df in (usable, loaded, arriving):
            capsys.readouterr()
            df.explain("codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_csv_files_grow_in_number(spark, tmp_path, monkeypatch):
    """No file, and so no task, takes a fixed share of the feed: a quarter of it went to one."""
    from twinledger.plans import catalog

    monkeypatch.setattr(catalog, "LINES_PER_FILE", 100)
    written = []
    cleanse_csv = catalog.cleanse.cleanse_csv
    monkeypatch.setattr(catalog.cleanse, "cleanse_csv", lambda s, raw, out: (written.append(raw), cleanse_csv(s, raw, out)))
    sf = "/root/testdata/sf0.001"
    for name in ("cleanse_from_csv", "cleanse_from_mixed_headers"):
        catalog.query_catalog()[name](spark, sf)
    lines = [spark.read.text(raw).groupBy(F.col("_metadata.file_path").alias("file")).count().collect() for raw in written]
    assert max(r["count"] for r in lines[0]) < 300
    assert sum("/3/" in r.file for r in lines[1]) > 1


def test_term_and_time_of_day(spark):
    assert one(spark, "Brand#12", lambda c: contains_ignore_case(c, " brand#1 "))
    assert one(spark, "x", lambda c: contains_ignore_case(c, "  "))
    assert one(spark, "2026-10-01T10:00:00Z", time_of_day) == "10:00:00Z"
    assert one(spark, "2026-10-01T", time_of_day) == "2026-10-01T"
    assert one(spark, "10:00", time_of_day) == "10:00"


def test_blank_ids_both_ways(spark):
    rows = [
        GOOD,
        but(trade_id="  "),
        but(trade_id=None),
        but(trade_id="T2", instrument="NaN "),  # padded, so no null token: only strict drops it
        but(trade_id="T3", buy_order_id="null"),
        but(trade_id="T4", sell_order_id=""),
        but(trade_id="none"),  # lower case is not a null token
        but(trade_id="\t T5 \n"),
        *[but(trade_id=t) for t in NULL_TOKENS],
    ]
    assert ids(drop_blank_ids(raw(spark, rows), strict=True)) == ["T1", "T5", "none"]
    basic = drop_blank_ids(raw(spark, rows), strict=False)
    assert ids(basic) == ["T1", "T2", "T3", "T4", "T5", "none"]
    kept = {r.trade_id: r for r in basic.collect()}
    assert kept["T3"].buy_order_id is None and kept["T4"].sell_order_id is None


def test_strict_checks_only_columns_there(spark):
    df = raw(spark, [GOOD, but(trade_id="T2", instrument=" ")]).drop("buy_order_id", "sell_order_id")
    assert ids(drop_blank_ids(df)) == ["T1"]


def test_quantity_is_cut_after_the_test(spark):
    rows = [but(trade_id="A", quantity="0.5"), but(trade_id="B", quantity="10.7"),
            but(trade_id="C", quantity="0"), but(trade_id="D", price="0.0"),
            but(trade_id="E", price="-99.99"), but(trade_id="F", quantity="99999999999")]
    got = {r.trade_id: r.quantity for r in keep_positive(coerce_numbers(raw(spark, rows))).collect()}
    # Beyond an INT the row is set aside.
    assert got == {"A": 0, "B": 10}


def test_first_copy_with_bad_time_takes_its_id_along(spark):
    rows = [
        but(trade_id="A", timestamp="not-a-date"),
        but(trade_id="A"),
        but(trade_id="B", price="-1"),  # not usable, so the second copy is the first
        but(trade_id="B", price="7"),
        but(trade_id="C", price="1"),
        but(trade_id="C", price="2"),
    ]
    got = cleanse_trades(raw(spark, rows), ["seq"]).collect()
    assert sorted((r.trade_id, float(r.price)) for r in got) == [("B", 7.0), ("C", 1.0)]


def test_metrics_in_one_pass_and_as_a_query(spark, tmp_path):
    feed = raw(spark, [GOOD, GOOD, but(trade_id=""), but(trade_id="T2")])
    m = cleanse_feed(feed, ["seq"], str(tmp_path / "out"))
    assert m == {
        "initial_records": 4, "retained_records": 2, "dropped_records": 2, "dropped_pct": 50.0,
    }
    assert cleanse_metrics(feed, cleanse_trades(feed, ["seq"])).first().asDict() == m
    back = read_trades_csv(spark, str(tmp_path / "out"))
    assert back.columns == TRADE_COLUMNS and ids(back) == ["T1", "T2"]


def test_csv_reads_text_only(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text(",".join(TRADE_COLUMNS) + "\n007,AAPL,1e3,10,B,S,1790847000\n")
    row = read_raw_csv(spark, str(path)).first()
    assert (row.trade_id, row.price, row.timestamp) == ("007", "1e3", "1790847000")


def test_summary(spark):
    got = dataset_summary(raw(spark, [GOOD, but(price=None)])).orderBy("column_index").collect()
    assert [r.column_name for r in got] == [*TRADE_COLUMNS, "seq"]
    assert got[2].total_rows == 2 and got[2].present == 1 and got[7].column_type == "int"


def test_csv_on_disk_to_csv(spark, tmp_path):
    """The first copy of an id is the first by file name, then by line."""
    header = ",".join(TRADE_COLUMNS)
    (tmp_path / "in").mkdir()
    for name, rows in (("b.csv", [but(price="9"), but(trade_id="T2")]), ("a.csv", [but(trade_id="T3"), but(price="7"), but(price="8")])):
        (tmp_path / "in" / name).write_text("\n".join([header, *(",".join(r) for r in rows)]))
    metrics = cleanse_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = {r.trade_id: r.price for r in read_trades_csv(spark, str(tmp_path / "out")).collect()}
    assert {k: float(v) for k, v in got.items()} == {"T1": 7.0, "T2": 150.5, "T3": 150.5}
    assert metrics == {"initial_records": 5, "retained_records": 3, "dropped_records": 2, "dropped_pct": 40.0}


def test_readme_example(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([",".join(TRADE_COLUMNS), ",".join(GOOD), ",".join(GOOD)]))
    clean = cleanse_trades(read_arriving_csv(spark, str(tmp_path)), order_by=ARRIVAL)
    assert [r.trade_id for r in clean.collect()] == ["T1"]


def test_numbers_beyond_a_store_are_set_aside(spark):
    df = raw(spark, [but(quantity="3000000000"), but(trade_id="T2", price="2e13"), but(trade_id="T3")])
    assert ids(keep_positive(coerce_numbers(df))) == ["T3"]
    aside = {r.trade_id: (r.reject_reasons, float(r.price), float(r.quantity)) for r in out_of_range(df).collect()}
    assert aside == {
        "T1": (["quantity is beyond the store's range"], 150.5, 3e9),
        "T2": (["price is beyond the store's range"], 2e13, 10.0),
    }
    assert {r.rule: r.rows for r in rejects_by_rule(df).collect()} == {"range": 2, "usable": 1}


def test_more_timestamp_layouts(spark):
    cases = [
        ("October 1, 2026", "2026-10-01T00:00:00Z"), ("10/01/2026 09:30 AM", "2026-10-01T09:30:00Z"),
        ("Oct 1 2026 9:30 PM", "2026-10-01T21:30:00Z"), ("Thu, 01 Oct 2026 10:00:00 GMT", "2026-10-01T10:00:00Z"),
        ("20261001T100000Z", "2026-10-01T10:00:00Z"), ("01-Oct-2026", "2026-10-01T00:00:00Z"),
        ("10/01/26", "2026-10-01T00:00:00Z"), ("10/01/99", "1999-10-01T00:00:00Z"),
        ("10/01/2026 09:30:15.250", "2026-10-01T09:30:15Z"), ("13/13/26", None), ("99991001T100000Z", None),
    ]
    assert evaluated(spark, cases, normalize_iso8601) == [want for _, want in cases]


def write_csv(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


HEAD = ",".join(TRADE_COLUMNS)
STAMP = "2026-10-01T10:00:00Z"


def test_columns_are_read_by_the_header_of_their_file(spark, tmp_path):
    path = write_csv(
        tmp_path / "in",
        a=f"instrument,trade_id,quantity,price,sell_order_id,timestamp,buy_order_id,venue\nAAPL,T1,7,100.5,S1,{STAMP},B1,X\n",
        b=f"{HEAD}\nT2,MSFT,3.25,4,B2,S2,{STAMP}\n",
        c=f"\ufefftrade_id,price,quantity,timestamp,sell_order_id,instrument\nT3,9,1,{STAMP},S3,IBM\n",
        d="",
        e=HEAD,
    )
    got = {r.trade_id: r for r in read_trades_csv(spark, path).collect()}
    assert set(got) == {"T1", "T2", "T3"}
    assert [got["T1"][c] for c in ("instrument", "quantity", "buy_order_id", "sell_order_id")] == ["AAPL", 7, "B1", "S1"]
    assert float(got["T1"].price) == 100.5 and float(got["T2"].price) == 3.25
    assert got["T3"].buy_order_id is None and got["T3"].instrument == "IBM"


def test_identifiers_are_checked_where_the_file_has_them(spark, tmp_path):
    path = write_csv(
        tmp_path / "in",
        a=f"trade_id,instrument,price,quantity,sell_order_id,timestamp\nT1,AAPL,1,1,S1,{STAMP}\nT2,AAPL,1,1,,{STAMP}\n",
        b=f"{HEAD}\nT3,AAPL,1,1,,S,{STAMP}\nT4,AAPL,1,1,B,S,{STAMP}\n",
        c=f"instrument,price,quantity,timestamp\nAAPL,1,1,{STAMP}\n",
    )
    cleanse_csv(spark, path, str(tmp_path / "out"))
    assert ids(read_trades_csv(spark, str(tmp_path / "out"))) == ["T1", "T4"]


def test_broken_lines_keep_text_and_reason(spark, tmp_path):
    path = write_csv(
        tmp_path / "in",
        a=f"{HEAD}\nT1,AAPL,1,1,B,S,{STAMP}\nT2,AAPL\nT3,AAPL,1,1,B,S,{STAMP},\n\nT4,AAPL,1,1,B,S,{STAMP},x,y\n\"T5,5\",AAPL,1,1,B,S,{STAMP}\n",
    )
    assert ids(read_raw_csv(spark, path)) == ["T1", "T5,5"]
    broken = {r.line_text: r.line_reason for r in broken_lines(spark, path).collect()}
    assert broken == {
        "T2,AAPL": "fewer fields than the header",
        f"T3,AAPL,1,1,B,S,{STAMP},": "more fields than the header",
        f"T4,AAPL,1,1,B,S,{STAMP},x,y": "more fields than the header",
    }
    # Asking for one column parses whole lines all the same.
    assert read_raw_csv(spark, path).select("trade_id").count() == 2
    assert read_raw_csv(spark, path).count() == 2


def test_a_name_that_comes_twice_counts_once(spark, tmp_path):
    path = write_csv(tmp_path / "in", a=f"{HEAD},price\nT1,AAPL,1.5,1,B,S,{STAMP},99\n")
    assert float(read_trades_csv(spark, path).first().price) == 1.5
