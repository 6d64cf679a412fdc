from __future__ import annotations

import json
import zipfile

from pyspark.sql import functions as F

from filingspark.functions import clean
from filingspark.operators import companies as C
from filingspark.operators import flatten
from filingspark.sources import archives, feeds


def obs(val, **more):
    base = {"end": "2024-03-31", "val": val, "accn": "a-1", "fy": 2024, "fp": "Q1", "form": "10-K/A", "filed": "2024-04-30"}
    return base | more


def company(cik, **facts):
    return json.dumps({"cik": cik, "entityName": "X", "facts": facts})


def as_rows(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "content string")


FACTS = [
    company(
        320193,
        dei={
            "EntityCommonStockSharesOutstanding": {"units": {"shares": [obs(5), obs(6.9, frame="CY24", fy=None)]}},
            "EntityPublicFloat": {"units": {"USD": [obs(1)], "EUR": [obs(2)]}},
        },
        **{"us-gaap": {"Assets": {"units": {"USD": [obs(-3.2)], "shares": [obs(1e20)]}},
                       "Cash": {"units": {"EUR": [obs(9007199254740993), obs(None)]}}}},
    ),
    company(12345678901, **{"us-gaap": {"Assets": {"units": {"shares": [obs(7)]}}}}),
    company(5),
]


def test_facts_flatten(spark):
    facts = feeds.company_facts(as_rows(spark, *FACTS))
    shares = flatten.shares_outstanding(facts).orderBy("val").collect()
    assert [(r.cik, r.val, r.fy, r.frame, r.form) for r in shares] == [
        ("0000320193", 5, 2024, "", "10-K/A"), ("0000320193", 6, 0, "CY24", "10-K/A"),
    ]
    assert [(r.currency, r.val) for r in flatten.public_float(facts).collect()] == [("USD", 1)]
    accounting = flatten.accounting_facts(facts)
    found = {(r.cik, r.type, r.unit, r.val) for r in accounting.collect()}
    assert found == {
        ("0000320193", "Assets", "USD", -3), ("0000320193", "Assets", "shares", 0),
        ("0000320193", "Cash", "EUR", 9007199254740993), ("0000320193", "Cash", "EUR", 0),
        ("12345678901", "Assets", "shares", 7),
    }
    one = flatten.accounting_facts(facts, units=["USD", "shares"])
    assert {(r.type, r.unit) for r in one.collect()} == {("Assets", "USD"), ("Assets", "shares")}
    assert one.count() == 2


def test_submissions(spark):
    whole = {
        "cik": "1", "name": "A, B\\C", "tickers": ["A", "A-B"], "exchanges": ["N"], "ein": "9",
        "formerNames": [], "addresses": {"mailing": {"city": "X"}, "business": {"city": "Y"}},
        "filings": {"recent": {"accessionNumber": ["a-1", "a-2"], "form": ["10-K/A", "8-K"],
                               "filingDate": ["2024-01-02", ""], "size": [1, 2], "isXBRL": [1, 0],
                               "primaryDocument": ["x/y.htm", "z.htm"]}},
    }
    overflow = {"accessionNumber": ["a-0"], "form": ["S-1"]}
    none = {"cik": "2", "filings": {"recent": {"accessionNumber": [], "form": []}}}
    parsed = feeds.submissions(as_rows(spark, *map(json.dumps, (whole, overflow, none))))
    assert parsed.count() == 2
    filings = flatten.filings(parsed).orderBy("accessionNumber").collect()
    assert [(r.cik, r.accessionNumber, r.form, r.size, r.isXBRL, str(r.filingDate)) for r in filings] == [
        ("0000000001", "a-1", "10-K/A", 1, True, "2024-01-02"), ("0000000001", "a-2", "8-K", 2, False, "None"),
    ]
    places = flatten.addresses(parsed).where("cik = '0000000001'").orderBy("kind").collect()
    assert [(r.kind, r.city) for r in places] == [("business", "Y"), ("mailing", "X")]
    meta = flatten.company_meta(parsed).where("cik = '0000000001'").first()
    assert (meta.tickers, meta.formerNames) == ('["A","A-B"]', "[]")
    stripped = clean.strip_specials(flatten.company_meta(parsed), ["name"]).where("ein = '9'").first()
    assert stripped.name == "A BC"
    letters = flatten.company_meta(parsed).where("ein = '9'").select(C.resolved_ticker(F.col("tickers")))
    assert letters.first()[0] == "AAB"


def test_known_companies_do_not_fan_out(spark):
    facts = feeds.company_facts(as_rows(spark, *FACTS))
    symbols = spark.createDataFrame([("320193", "A"), ("320193", "B"), ("77", "C")], "cik_str string, ticker string")
    assert [r.cik for r in C.known_companies(facts, symbols).collect()] == ["0000320193"]


def test_ticker_list(spark):
    text = json.dumps({"0": {"cik_str": 320193, "ticker": "AAPL", "title": "Apple"}, "1": {"cik_str": 5, "ticker": "F", "title": "Five"}})
    found = feeds.ticker_list(as_rows(spark, text)).orderBy("ticker").collect()
    assert [tuple(r) for r in found] == [("0000320193", "AAPL", "Apple"), ("0000000005", "F", "Five")]


def test_unreadable(spark):
    rows = as_rows(spark, '{"cik": 1, "facts": {}}', '{"cik": 2, "fac', "", None, '{"entityName": "x"}')
    assert feeds.unreadable(rows).count() == 3
    assert [r.cik for r in feeds.company_facts(rows).collect()] == ["0000000001"]


def test_screener(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("Symbol,Name,Market Cap,Country,Sector,Industry\nA,x,,US,S,I\nB,y,12.7,US,S,I\nC,z,100,,,\n")
    found = feeds.screener_csv(spark, str(path)).orderBy("symbol").collect()
    assert [r.market_cap for r in found] == [-1, 12, 100]


def test_news_page_and_children(spark, tmp_path):
    article = {
        "id": 43, "author": "Desk", "created": "Mon, 03 Jun 2024 04:15:00 -0400",
        "updated": "Mon, 03 Jun 2024 04:15:00 -0400", "title": "T", "teaser": " ", "body": "<h3>x</h3>",
        "url": "u", "image": [{"size": "thumb", "url": "i"}], "channels": [{"name": "Movers"}],
        "stocks": [{"name": "A"}, {"name": "B"}], "tags": [],
    }
    (tmp_path / "page0.json").write_text(json.dumps([article, article | {"id": 44}], indent=1))
    pages = feeds.news_pages(spark, str(tmp_path))
    normal = flatten.normalise_articles(pages).orderBy("id").collect()
    assert [(r.id, r.created, r.channels, r.stocks, r.tags) for r in normal] == [
        (43, 1717402500, ["Movers"], ["A", "B"], []), (44, 1717402500, ["Movers"], ["A", "B"], []),
    ]
    assert flatten.article_images(pages).count() == 2
    children = flatten.article_children(flatten.normalise_articles(pages), ["stocks", "tags"])
    assert children.count() == 4


def test_webhook(spark, tmp_path):
    event = {
        "id": "w", "kind": "News/v1", "data": {"action": "Created", "id": 9, "timestamp": "2024-06-03T08:15:01.5Z",
        "content": {"id": 5, "created_at": "2024-06-03T08:15:00Z", "updated_at": "2024-06-03T08:15:00Z", "title": "T",
                    "body": "b", "authors": ["A", "B"], "teaser": " ", "url": "u", "tags": ["t"],
                    "securities": [{"symbol": "ZZT", "exchange": "NYSE", "primary": True}], "channels": ["C"]}},
    }
    (tmp_path / "e.json").write_text(json.dumps(event, indent=2) + "\n")
    (tmp_path / "f.json").write_text(json.dumps({"id": "no content", "kind": "x"}))
    (row,) = feeds.news_webhooks(spark, str(tmp_path)).collect()
    (tmp_path / "g").mkdir()
    (tmp_path / "g/e.json").write_text(json.dumps(event) + "\n" + json.dumps(event) + "\n")
    assert feeds.news_webhooks(spark, str(tmp_path / "g"), lines=True).count() == 2
    assert (row.id, row.author, row.created, row.stocks, row.action) == (5, "A, B", 1717402500, ["ZZT"], "Created")


def test_candles_and_hours(spark):
    full = {"symbol": "A", "empty": False, "candles": [{"open": 10.5, "high": 11.25, "low": 10.0, "close": 11.0, "volume": 1200, "datetime": 1717402500000}]}
    empty = {"symbol": "B", "empty": True, "candles": []}
    found = feeds.price_history(as_rows(spark, json.dumps(full), json.dumps(empty))).collect()
    assert [(r.ticker, r.datetime, r.volume) for r in found] == [("A", 1717402500, 1200)]
    open_day = {"equity": {"EQ": {"isOpen": True, "sessionHours": {"regularMarket": [{"start": "2025-01-10T09:30:00-05:00", "end": "2025-01-10T16:00:00-05:00"}]}}}}
    holiday = {"equity": {"EQ": {"isOpen": False}}}
    weekend = {"equity": {"equity": {"isOpen": False}}}
    days = spark.createDataFrame(
        [("2025-01-10", json.dumps(open_day)), ("2025-01-09", json.dumps(holiday)), ("2025-01-11", json.dumps(weekend))],
        "day string, content string",
    )
    hours = {r.day: (r.is_open, r.start) for r in feeds.market_hours(days).collect()}
    assert hours == {"2025-01-10": (True, 1736519400), "2025-01-09": (False, None), "2025-01-11": (False, None)}


def test_zip_scan(spark, tmp_path):
    path = tmp_path / "facts.zip"
    with zipfile.ZipFile(path, "w") as z:
        for i in range(23):
            z.writestr(f"CIK{i}.json", company(i))
        z.writestr("placeholder.txt", "nothing")
    found = archives.zip_scan(spark, str(path), slice_bytes=700)
    assert sorted(r.entry for r in found.collect()) == sorted(f"CIK{i}.json" for i in range(23))
    assert feeds.company_facts(found).select("cik").distinct().count() == 23


def test_empty_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "none.zip", "w"):
        pass
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        z.writestr("a.json", "{}")
    found = archives.zip_scan(spark, f"{tmp_path}/*.zip").select("entry", "content")
    assert [tuple(r) for r in found.collect()] == [("a.json", "{}")]


def test_empty_partitions_leave_no_archive(spark, tmp_path):
    df = spark.createDataFrame([("a.json", "{}"), ("b.json", "[]")], "entry string, content string")
    archives.write_archives(df.repartition(8), str(tmp_path / "some"))
    assert 1 <= len(list((tmp_path / "some").glob("*.zip"))) <= 3
    assert not list((tmp_path / "some").glob("*.tmp"))
    found = archives.zip_scan(spark, f"{tmp_path}/some/*.zip").select("entry", "content")
    assert sorted(map(tuple, found.collect())) == [("a.json", "{}"), ("b.json", "[]")]
    archives.write_archives(df.where("false").repartition(3), str(tmp_path / "none"))
    assert archives.zip_scan(spark, f"{tmp_path}/none/*.zip").count() == 0


def test_archives_round_trip(spark, tmp_path):
    df = spark.range(50).select(F.concat(F.lit("e"), "id").alias("entry"), F.concat(F.lit("ü"), "id").alias("content"))
    archives.write_archives(df.repartition(3), str(tmp_path / "z"))
    back = archives.zip_scan(spark, f"{tmp_path}/z/*.zip", slice_bytes=500).select("entry", "content")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_webhooks_are_applied(spark):
    stored = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], "id int, title string, updated int")
    hooks = spark.createDataFrame(
        [(1, "new", 5, "Updated"), (1, "old", 4, "Updated"), (2, "b", 9, "Removed"), (2, "x", 3, "Updated"), (4, "d", 1, "Created")],
        "id int, title string, updated int, action string",
    )
    found = sorted(map(tuple, feeds.apply_webhooks(stored, hooks).collect()))
    assert found == [(1, "new", 5), (3, "c", 1), (4, "d", 1)]


def test_landed_bodies_meet_the_manifest(spark, tmp_path):
    for accession, name in (("a1", "x.htm"), ("a1", "y.txt"), ("a2", "x.htm"), ("a9", "z.htm")):
        (tmp_path / accession).mkdir(exist_ok=True)
        (tmp_path / accession / name).write_text(f"{accession} ü {name}")
    rows = [("a1", "x.htm"), ("a1", "y.txt"), ("a2", "x.htm"), ("a3", "w.htm")]
    manifest = spark.createDataFrame(rows, "accessionNumber string, filename string")
    found = {r.rawContent for r in feeds.filing_bodies(spark, str(tmp_path), manifest).collect()}
    assert found == {"a1 ü x.htm", "a2 ü x.htm"}


def test_manifest(spark):
    names = ["a.htm", "b.xhtml", "c.html", "d.txt", "htm.txt", "e.HTM", "noext"]
    df = spark.createDataFrame([(n,) for n in names], "filename string")
    assert sorted(r.filename for r in feeds.htm_files(df).collect()) == ["a.htm", "b.xhtml", "c.html"]
