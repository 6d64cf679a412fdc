"""Registered queries over company facts, submissions, filings and stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from filingspark import schemas
from filingspark.functions import clean, dates
from filingspark.operators import companies as C
from filingspark.operators import flatten, query as Q, stats
from filingspark.operators import keys as K
from filingspark.operators import text as X
from filingspark.plans.proxies import Tables, sql
from filingspark.plans.registry import query
from filingspark.session import scratch
from filingspark.sources import archives, feeds, tables as store, versions

_FACT = """cik, "end"::VARCHAR AS "end", {val} AS val, accn, fy, fp, form, filed::VARCHAR AS filed, frame"""
_SHARES = _FACT.format(val="CAST(trunc(quantity) AS BIGINT)")
_FLOAT = _FACT.format(val="CAST(trunc(val) AS BIGINT)")
_ACCOUNTING = """SELECT {shares}, 'us-gaap' AS taxonomy, type, u AS unit FROM
    (SELECT *, unnest([unit, 'USD/shares']) AS u,
            unnest([val, quantity]) AS v FROM facts)""".format(
    shares=_FACT.format(val="CAST(trunc(v) AS BIGINT)")
)


@query("facts_roundtrip", sql(
    """SELECT 'shares' AS kind, count(*) AS n, sum(CAST(trunc(quantity) AS BIGINT))::BIGINT AS total FROM facts
    UNION ALL SELECT 'float', count(*), sum(CAST(trunc(val) AS BIGINT))::BIGINT FROM facts
    UNION ALL SELECT 'accounting', 2 * count(*),
        (sum(CAST(trunc(val) AS BIGINT)) + sum(CAST(trunc(quantity) AS BIGINT)))::BIGINT FROM facts""",
    "facts"))
def facts_roundtrip(t: Tables):
    objects = t.facts_json()
    parts = {
        "shares": flatten.shares_outstanding(feeds.company_facts(objects, only=flatten.SHARES_ONLY)),
        "float": flatten.public_float(feeds.company_facts(objects, only=flatten.FLOAT_ONLY)),
        "accounting": flatten.accounting_facts(feeds.company_facts(objects, only=flatten.ACCOUNTING_ONLY)),
    }
    rows = None
    for kind, part in parts.items():
        one = part.agg(F.count("*").alias("n"), F.sum("val").alias("total")).withColumn("kind", F.lit(kind))
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query("shares_outstanding", sql(f"SELECT {_SHARES} FROM facts", "facts"))
def shares_outstanding(t: Tables):
    return flatten.shares_outstanding(feeds.company_facts(t.facts_json(), only=flatten.SHARES_ONLY))


@query("public_float", sql(f"SELECT {_FLOAT}, 'USD' AS currency FROM facts", "facts"))
def public_float(t: Tables):
    return flatten.public_float(feeds.company_facts(t.facts_json(), only=flatten.FLOAT_ONLY))


@query("accounting_facts", sql(_ACCOUNTING, "facts"))
def accounting_facts(t: Tables):
    return flatten.accounting_facts(feeds.company_facts(t.facts_json(), only=flatten.ACCOUNTING_ONLY)).drop("start")


@query("accounting_legacy_key", sql(
    """SELECT cik, "end"::VARCHAR AS "end", fy,
        min(CAST(trunc(least(val, quantity)) AS BIGINT))::BIGINT AS val FROM facts GROUP BY ALL""", "facts"))
def accounting_legacy_key(t: Tables):
    """The narrow key (cik, end, fy), under which most facts are dropped; lowest value wins."""
    rows = flatten.accounting_facts(feeds.company_facts(t.facts_json(), only=flatten.ACCOUNTING_ONLY))
    key = schemas.LEGACY_ACCOUNTING_KEY
    return K.first_wins(rows, key, ["val", "accn", "type", "unit", "frame"]).select(*key, "val")


_SECOND = "replace(accessionNumber, '-000001', '-000002')"


@query("filings_flat", sql(
    f"""SELECT cik, accessionNumber, filingDate::VARCHAR AS filingDate, form, size, primaryDocument,
        CAST(epoch(filingDate) AS BIGINT) + 59400 AS accepted, true AS isXBRL FROM filings
    UNION ALL SELECT cik, {_SECOND}, filingDate::VARCHAR, '10-K/A', size, primaryDocument,
        CAST(epoch(filingDate) AS BIGINT) + 59400, false FROM filings""", "filings"))
def filings_flat(t: Tables):
    rows = flatten.filings(feeds.submissions(t.submissions_json()))
    accepted = F.unix_timestamp("acceptanceDateTime").alias("accepted")
    return rows.select(
        "cik", "accessionNumber", "filingDate", "form", "size", "primaryDocument", accepted, "isXBRL"
    )


@query("submissions_roundtrip", sql(
    """SELECT cik, count(*) * 2 AS filings, sum(size)::BIGINT * 2 AS size FROM filings GROUP BY cik""",
    "filings"))
def submissions_roundtrip(t: Tables):
    rows = flatten.filings(feeds.submissions(t.submissions_json()))
    return rows.groupBy("cik").agg(F.count("*").alias("filings"), F.sum("size").alias("size"))


@query("addresses", sql(
    """SELECT cik, kind, prefix || ' ' || title AS street1, '' AS street2, country AS city,
        country AS "stateOrCountry", substr(cik, 6, 5) AS "zipCode",
        country AS "stateOrCountryDescription"
    FROM (SELECT DISTINCT c.* FROM companies c JOIN filings f USING (cik)),
         (VALUES ('mailing', 'M'), ('business', 'B')) AS k(kind, prefix)""", "companies", "filings"))
def addresses(t: Tables):
    rows = flatten.addresses(feeds.submissions(t.submissions_json()))
    return K.first_wins(rows, schemas.KEYS["addresses"], schemas.ADDRESS_COLUMNS)


@query("company_meta", sql(
    """SELECT cik, title AS name, accessionNumber AS ein, sector AS "sicDescription",
        '["' || ticker || '"]' AS tickers, '["NYSE","' || sector || '"]' AS exchanges,
        '[{"name":"Old ' || title || '","from":"2001","to":"2002"}]' AS "formerNames",
        true AS owner, false AS issuer
    FROM companies JOIN filings USING (cik)""", "companies", "filings"))
def company_meta(t: Tables):
    rows = flatten.company_meta(feeds.submissions(t.submissions_json()))
    return rows.select(
        "cik", "name", "ein", "sicDescription", "tickers", "exchanges", "formerNames",
        F.col("insiderTransactionForOwnerExists").alias("owner"),
        F.col("insiderTransactionForIssuerExists").alias("issuer"),
    )


@query("ticker_list", sql("SELECT cik AS cik_str, ticker, title FROM companies", "companies"))
def ticker_list(t: Tables):
    one = F.create_map(
        F.col("cik").cast("int").cast("string"),
        F.struct(F.col("cik").cast("bigint").alias("cik_str"), "ticker", "title"),
    )
    return feeds.ticker_list(t.companies().select(F.to_json(one).alias("content")))


@query("screener_clean", sql(
    """SELECT ticker AS symbol, CASE WHEN market_cap < 0 THEN -1 ELSE CAST(trunc(market_cap) AS BIGINT) END
        AS market_cap, country, sector, title AS industry FROM companies""", "companies"))
def screener_clean(t: Tables):
    raw = t.companies().select(
        F.col("ticker").alias("Symbol"),
        F.when(F.col("market_cap") < 0, "").otherwise(F.col("market_cap").cast("string")).alias("Market Cap"),
        F.col("country").alias("Country"),
        F.col("sector").alias("Sector"),
        F.col("title").alias("Industry"),
    )
    path = scratch(t.spark, "screener")
    raw.write.csv(path, header=True, emptyValue="")
    return feeds.screener_csv(t.spark, path)


@query("zip_scan", sql(
    """SELECT cik || '-' || accn AS filing, count(*) AS n FROM facts GROUP BY ALL""", "facts"))
def zip_scan(t: Tables):
    path, counted = scratch(t.spark, "zip"), scratch(t.spark, "counted")
    filing = F.substring_index("entry", "-", 4)
    cik = F.from_json("content", "cik bigint")["cik"]
    for wave in archives.write_waves(t.facts_json(), path):
        found = archives.zip_scan(t.spark, wave, slice_bytes=1 << 20)
        found.groupBy(filing.alias("filing")).agg(F.count(cik).alias("n")).write.mode("append").parquet(counted)
    return t.spark.read.parquet(counted).groupBy("filing").agg(F.sum("n").alias("n"))


@query("htm_manifest", """SELECT page_id, url FROM (SELECT page_id, url,
    CASE page_id % 3 WHEN 0 THEN 'p' || page_id || '.htm' WHEN 1 THEN 'p' || page_id || '.xhtml'
    ELSE 'htm' || page_id || '.txt' END AS filename FROM pages) WHERE page_id % 3 <> 2""")
def htm_manifest(t: Tables):
    number = F.col("page_id").cast("string")
    name = (
        F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("p"), number, F.lit(".htm")))
        .when(F.col("page_id") % 3 == 1, F.concat(F.lit("p"), number, F.lit(".xhtml")))
        .otherwise(F.concat(F.lit("htm"), number, F.lit(".txt")))
    )
    return feeds.htm_files(t["pages"].withColumn("filename", name)).select("page_id", "url")


_LINE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"
_LINE_KEYS = ["l_orderkey", "l_linenumber"]


@query("insert_ignore", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1""")
def insert_ignore(t: Tables):
    lines = t["lineitem"].select(*_LINE_KEYS, *_LINE_ORDER.split(", "))
    done = t["orders"].where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    target = lines.join(done, "l_orderkey", "left_semi")
    new = K.insert_ignore(target, lines, _LINE_KEYS, _LINE_ORDER.split(", "))
    return new.select(*_LINE_KEYS, "l_partkey", "l_suppkey", "l_extendedprice")


@query("append", """SELECT c_mktsegment AS segment, 2 * count(*) AS n, 0 AS blank FROM customer GROUP BY 1""")
def append(t: Tables):
    path = scratch(t.spark, "append")
    rows = t["customer"].select("c_custkey", F.col("c_mktsegment").alias("segment"), F.lit("").alias("note"))
    store.append(rows, path)
    store.append(rows, path)
    stored = t.spark.read.parquet(path)
    return stored.groupBy("segment").agg(
        F.count("*").alias("n"), F.count("note").cast("int").alias("blank")
    )


@query("upsert_last_wins", """SELECT user_id, max(event_id) AS event_id,
    arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
    FROM events GROUP BY user_id""")
def upsert_last_wins(t: Tables):
    rows = t["events"].select("user_id", "event_id", "event_type", "value")
    target = K.last_wins(rows.where("event_type = 'view'"), ["user_id"], ["event_id"])
    return K.upsert(target, rows, ["user_id"], ["event_id"])


@query("delete_rows", """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE o_orderstatus <> 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def delete_rows(t: Tables):
    kept = K.delete_where(t["orders"], F.col("o_orderstatus") == "F")
    gone = t["customer"].where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return K.delete_ids(kept, gone, "o_custkey").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("upsert_versioned", """SELECT user_id, max(event_id) AS event_id,
    arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
    FROM events GROUP BY user_id""")
def upsert_versioned(t: Tables):
    """The same upsert into a stored table, of which only the touched buckets are written."""
    rows = t["events"].select("user_id", "event_id", "event_type", "value")
    first = K.last_wins(rows.where("event_type = 'view'"), ["user_id"], ["event_id"])
    table = versions.create(first, scratch(t.spark, "users"), ["user_id"])
    table.upsert(rows, ["event_id"])
    return table.rows()


@query("delete_versioned", """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE o_orderstatus <> 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)""")
def delete_versioned(t: Tables):
    """The same deletes, by ids and by condition, from a stored table."""
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus")
    table = versions.create(orders, scratch(t.spark, "orders"), ["o_orderkey"])
    table.delete_where(F.col("o_orderstatus") == "F")
    table.delete_ids(t["lineitem"].where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")))
    return table.rows()


@query("point_lookup", "SELECT doc_id, text, lang, source, n_chars FROM documents WHERE doc_id = 42")
def point_lookup(t: Tables):
    return Q.point_lookup(t["documents"], "doc_id", 42)


@query("create_tables", """SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik_str,
    'T' || c_custkey AS ticker, c_name AS title FROM customer""")
def create_tables(t: Tables):
    root = scratch(t.spark, "tables")
    store.create_tables(t.spark, root)
    rows = t.companies().select(F.col("cik").alias("cik_str"), "ticker", "title")
    symbols = f"{root}/symbols"
    store.insert_ignore_into(rows, symbols, schemas.KEYS["symbols"], ["ticker"])
    store.insert_ignore_into(rows, symbols, schemas.KEYS["symbols"], ["ticker"])
    store.create_tables(t.spark, root, ["symbols"])
    return t.spark.read.parquet(symbols)


@query("snapshot", "SELECT doc_id, quality, toxic FROM labels")
def snapshot(t: Tables):
    return store.snapshot(t["labels"], scratch(t.spark, "snapshot"))


@query("table_query", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'O' AND o_totalprice > 1000 AND o_orderkey > 0
    ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 25""")
def table_query(t: Tables):
    where = [("o_orderstatus", "eq", "O"), ("o_totalprice", "gt", 1000), ("o_orderkey", "gt", 0)]
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    return Q.table_query(t["orders"], columns, where, sort=["o_totalprice", "o_orderkey"], limit=25)


@query("clustered_read", sql(
    """SELECT cik, accessionNumber, form FROM filings WHERE cik IN ('0000000001', '0000000044')""", "filings"))
def clustered_read(t: Tables):
    path = scratch(t.spark, "clustered")
    store.write_clustered(t.filings(), path, "cik", ["form"], buckets=8)
    rows = store.read_clustered(t.spark, path, "cik", ["0000000001", "0000000044"])
    return rows.select("cik", "accessionNumber", "form")


@query("unique_values", sql("SELECT DISTINCT ticker FROM candles_raw", "candles_raw"))
def unique_values(t: Tables):
    return Q.unique_values(t.candles_raw(), "ticker")


@query("paged_query", """SELECT p_partkey, p_name, p_retailprice FROM part
    WHERE p_size > 10 AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')
    ORDER BY p_retailprice DESC, p_partkey LIMIT 20 OFFSET 10""")
def paged_query(t: Tables):
    part = t["part"].withColumn("_down", -F.col("p_retailprice"))
    brands = ("p_brand", ["Brand#1", "Brand#2", "Brand#3"])
    columns = ["p_partkey", "p_name", "p_retailprice"]
    return Q.paged_query(part, "p_size > 10", columns, ["_down", "p_partkey"], 10, 20, brands)


@query("filing_type_filter", sql(
    "SELECT cik, accessionNumber, form FROM filings WHERE form IN ('1-URGENT', '2-HIGH')", "filings"))
def filing_type_filter(t: Tables):
    return Q.filing_types(t.filings(), ["1-URGENT", "2-HIGH"]).select("cik", "accessionNumber", "form")


@query("nonempty_content", """SELECT page_id FROM pages WHERE regexp_matches(regexp_extract(
    regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->', '', 'g'),
    '(?is)<b(?:\\s[^>]*)?>(.*)$', 1), '>\\s*[^<\\s]|^\\s*[^<\\s]')""")
def nonempty_content(t: Tables):
    pages = t.dealt("pages").withColumn("clean", X.html_strings(F.col("html")))
    return Q.nonempty(pages, "clean").select("page_id")


@query("known_companies", sql(
    """SELECT cik, accessionNumber, form FROM filings
    WHERE cik IN (SELECT cik FROM companies WHERE sector = 'BUILDING')""", "filings", "companies"))
def known_companies(t: Tables):
    symbols = t.companies().where("sector = 'BUILDING'").withColumnRenamed("cik", "cik_str")
    twice = symbols.unionByName(symbols.withColumn("ticker", F.lit("other")))
    return C.known_companies(t.filings(), twice).select("cik", "accessionNumber", "form")


@query("unloaded_filings", sql(
    """SELECT cik, accessionNumber FROM filings WHERE filingDate >=
        (SELECT max(filingDate) - 365 FROM filings)""", "filings"))
def unloaded_filings(t: Tables):
    filings = t.filings()
    newest = filings.agg(F.date_sub(F.max("filingDate"), 365)).scalar()
    loaded = filings.where(F.col("filingDate") < newest).select(
        F.replace("accessionNumber", F.lit("-"), F.lit("")).alias("accessionNumber")
    )
    return C.unloaded_filings(filings, loaded).select("cik", "accessionNumber")


@query("resolve_company", sql(
    "SELECT cik AS cik_str, title FROM companies WHERE contains(title, '00007')", "companies"))
def resolve_company(t: Tables):
    return C.resolve_company(t.companies().withColumnRenamed("cik", "cik_str"), "00007")


@query("resolve_companies", sql(
    """, names AS (SELECT DISTINCT CASE WHEN c_custkey % 5 = 0 THEN right(c_name, 3) ELSE substr(c_name, 8, 11) END AS name
        FROM customer WHERE c_custkey % 7 < 3 UNION SELECT 'r#' UNION SELECT 'nobody')
    SELECT name, cik AS cik_str, title FROM names JOIN companies ON contains(title, name)""", "companies"))
def resolve_companies(t: Tables):
    """Names that are the end of a title, the middle of one, a part of all, or of none."""
    own = t["customer"].where("c_custkey % 7 < 3").selectExpr(
        "CASE WHEN c_custkey % 5 = 0 THEN right(c_name, 3) ELSE substr(c_name, 8, 11) END AS name"
    )
    others = t.spark.createDataFrame([("r#",), ("nobody",)], "name string")
    return C.resolve_companies(t.companies().withColumnRenamed("cik", "cik_str"), own.unionByName(others))


@query("company_dossier", sql(
    """, w AS (SELECT DISTINCT cik, ticker FROM companies)
    SELECT cik, 'meta' AS section, -1::BIGINT AS at, '{"cik":"' || cik || '","name":"' || title || '"}' AS item
        FROM companies SEMI JOIN w USING (cik)
    UNION ALL SELECT cik, 'address', -1, '{"cik":"' || cik || '","city":"' || country || '"}'
        FROM companies SEMI JOIN w USING (cik)
    UNION ALL SELECT w.cik, 'news', created, '{"id":' || id || '}' FROM articles JOIN w USING (ticker)
        WHERE created >= 1704412800
    UNION ALL SELECT w.cik, 'candle', datetime, '{"volume":' || volume || '}' FROM candles JOIN w USING (ticker)
        WHERE datetime > 1704412800
    UNION ALL SELECT f.cik, 'filing', CAST(epoch(filingDate) AS BIGINT),
        '{"link":"https://www.sec.gov/Archives/edgar/data/' || ltrim(f.cik, '0') || '/' ||
        replace(accessionNumber, '-', '') || '/' || primaryDocument || '"}'
        FROM filings f SEMI JOIN w USING (cik) WHERE epoch(filingDate) > 883612800""",
    "companies", "articles", "candles", "filings").replace("\n, w AS", ",\nw AS"))
def company_dossier(t: Tables):
    companies = t.companies()
    sections = C.dossier(
        companies,
        companies.select("cik", F.col("title").alias("name")),
        companies.select("cik", F.col("country").alias("city")),
        t.articles(),
        t.candles(),
        t.filings(),
        1704412800,
        filed_since=883612800,
    )
    volume = F.concat(F.lit('{"volume":'), F.get_json_object("item", "$.volume"), F.lit("}"))
    number = F.concat(F.lit('{"id":'), F.get_json_object("item", "$.id"), F.lit("}"))
    item = F.when(F.col("section") == "candle", volume).when(F.col("section") == "news", number)
    return sections.withColumns({"item": item.otherwise(F.col("item")), "at": F.coalesce("at", F.lit(-1))})


@query("type_frequency", sql(
    "SELECT form, count(*) AS n FROM filings GROUP BY form ORDER BY n DESC, form", "filings"))
def type_frequency(t: Tables):
    return stats.type_frequency(t.filings(), "form")


@query("filer_freshness", sql(
    """SELECT count(DISTINCT cik) AS total, count(DISTINCT CASE WHEN filingDate > (SELECT max(filingDate) - 30
        FROM filings) THEN cik END) AS fresh FROM filings""", "filings"))
def filer_freshness(t: Tables):
    filings = t.filings()
    return stats.filer_freshness(filings, filings.agg(F.max("filingDate")).scalar(), 30)


@query("doc_count", "SELECT count(*) AS n FROM documents")
def doc_count(t: Tables):
    return stats.doc_count(t["documents"])


@query("histogram", """SELECT b AS bin, lo + b * w AS lower, lo + (b + 1) * w AS upper, coalesce(n, 0) AS n,
        100.0 * coalesce(n, 0) / total AS percent
    FROM (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 10 AS w,
        count(o_totalprice) AS total FROM orders), (SELECT CAST(range AS INTEGER) AS b FROM range(10))
    LEFT JOIN (SELECT least(CAST(floor((o_totalprice - lo2) / w2) AS INTEGER), 9) AS b2, count(*) AS n
        FROM orders, (SELECT min(o_totalprice) AS lo2, (max(o_totalprice) - min(o_totalprice)) / 10 AS w2
        FROM orders) GROUP BY 1) ON b2 = b""")
def histogram(t: Tables):
    return stats.histogram(t["orders"], "o_totalprice", 10)


@query("backlog", """SELECT event_type AS topic, CAST(sum(high - low) AS BIGINT) AS backlog FROM (
    SELECT event_type, user_id, min(event_id) AS low, max(event_id) AS high FROM events GROUP BY ALL)
    GROUP BY 1""")
def backlog(t: Tables):
    offsets = t["events"].groupBy(F.col("event_type").alias("topic"), F.col("user_id").alias("partition"))
    return stats.backlog(offsets.agg(F.min("event_id").alias("low"), F.max("event_id").alias("high")))


@query("keep_first", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1""")
def keep_first(t: Tables):
    order = _LINE_ORDER.split(", ")
    first = K.first_wins(t["lineitem"].select(*_LINE_KEYS, *order), _LINE_KEYS, order)
    return first.select(*_LINE_KEYS, "l_partkey", "l_extendedprice")


@query("clean_strings", """SELECT page_id, translate(url, ',\\/', '') AS url, html FROM pages""")
def clean_strings(t: Tables):
    return clean.strip_specials(t["pages"], ["url"])


@query("cik_format", """SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS padded,
    CASE WHEN o_custkey = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS bare,
    '1' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS eleven FROM orders""")
def cik_format(t: Tables):
    padded = clean.pad_cik(F.col("o_custkey"))
    eleven = F.concat(F.lit("1"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0"))
    return t["orders"].select(
        "o_orderkey", padded.alias("padded"), clean.unpad_cik(padded).alias("bare"),
        clean.pad_cik(eleven).alias("eleven"),
    )


@query("filing_links", sql(
    """SELECT accessionNumber, 'https://www.sec.gov/Archives/edgar/data/' || ltrim(cik, '0') || '/' ||
    replace(accessionNumber, '-', '') || '/' || primaryDocument AS link FROM filings""", "filings"))
def filing_links(t: Tables):
    link = clean.filing_link(F.col("cik"), F.col("accessionNumber"), F.col("primaryDocument"))
    return t.filings().select("accessionNumber", link.alias("link"))


@query("safe_int", """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(trunc(o_totalprice) AS BIGINT)
    WHEN 1 THEN CAST(trunc(-o_totalprice) AS BIGINT) WHEN 2 THEN 0 WHEN 3 THEN 0
    ELSE 9007199254740993 + o_orderkey END AS val FROM orders""")
def safe_int(t: Tables):
    kind = F.col("o_orderkey") % 5
    price = F.col("o_totalprice").cast("string")
    text = (
        F.when(kind == 0, price)
        .when(kind == 1, F.concat(F.lit("-"), price))
        .when(kind == 2, F.lit("1e20"))
        .when(kind == 3, F.lit(None))
        .otherwise((F.col("o_orderkey") + 9007199254740993).cast("string"))
    )
    return t["orders"].select("o_orderkey", clean.safe_long(text).alias("val"))


@query("alpha_ticker", r"""SELECT url, regexp_replace(url, '[^\p{L}]', '', 'g') AS letters FROM pages""")
def alpha_ticker(t: Tables):
    return t["pages"].select("url", clean.letters_only(F.col("url")).alias("letters"))


@query("humanise", """SELECT o_orderkey, CASE WHEN n > 1000000 THEN printf('%.1fM', n / 1000000.0)
    WHEN n > 1000 THEN printf('%.1fK', n / 1000.0) ELSE CAST(n AS VARCHAR) END AS shown
    FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * (o_orderkey % 50) + o_orderkey % 7 AS n
    FROM orders)""")
def humanise(t: Tables):
    n = F.floor("o_totalprice").cast("bigint") * (F.col("o_orderkey") % 50) + F.col("o_orderkey") % 7
    return t["orders"].select("o_orderkey", clean.humanise(n).alias("shown"))


@query("sgml_header", """, doc AS (SELECT s_suppkey AS doc, s_name, n_name FROM supplier
        JOIN nation ON n_nationkey = s_nationkey)
    SELECT doc, p AS pos, path, l AS level, key, value FROM doc, LATERAL (VALUES
    (0, 'FILER', 0, 'FILER', ''),
    (1, 'FILER/COMPANY DATA', 1, 'COMPANY DATA', ''),
    (2, 'FILER/COMPANY DATA/COMPANY CONFORMED NAME', 2, 'COMPANY CONFORMED NAME', s_name),
    (3, 'FILER/COMPANY DATA/STATE', 2, 'STATE', n_name),
    (4, 'FILER/FORMER COMPANY', 1, 'FORMER COMPANY', ''),
    (5, 'FILER/FORMER COMPANY/FORMER CONFORMED NAME', 2, 'FORMER CONFORMED NAME', 'Old ' || s_name),
    (6, 'FILER/FORMER COMPANY2', 1, 'FORMER COMPANY2', ''),
    (7, 'FILER/FORMER COMPANY2/FORMER CONFORMED NAME', 2, 'FORMER CONFORMED NAME', 'Older ' || s_name)
    ) AS v(p, path, l, key, value)""".replace(", doc AS", "WITH doc AS", 1))
def sgml_header(t: Tables):
    return X.sgml_header(t.headers(), "doc", "text")


@query("clean_filings", """SELECT lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS accessionNumber, 8 AS entries
    FROM supplier""")
def clean_filings(t: Tables):
    raw = t.headers().select(
        F.lpad(F.col("doc").cast("string"), 10, "0").alias("accessionNumber"),
        F.lit("main.htm").alias("filename"),
        F.col("text").alias("rawContent"),
    )
    blank = raw.withColumns({"filename": F.lit("blank.htm"), "rawContent": F.lit("nothing to read")})
    path = scratch(t.spark, "artifacts")
    key = schemas.KEYS["fundamentals_artifacts"]
    for _ in range(2):  # the second run finds every key stored
        store.insert_ignore_into(X.clean_filings(raw.unionByName(blank)), path, key, ["rawContent"])
    stored = t.spark.read.parquet(path)
    return stored.select("accessionNumber", F.size("cleanContent").alias("entries"))


_FORMATS = """CASE event_id % 5 WHEN 1 THEN CAST(epoch(CAST(ts AS DATE)) AS BIGINT)
    WHEN 2 THEN CAST(floor(epoch(ts) / 60) AS BIGINT) * 60 ELSE CAST(floor(epoch(ts)) AS BIGINT) END"""


@query("parse_rfc2822", f"SELECT event_id, {_FORMATS} AS epoch FROM events")
def parse_rfc2822(t: Tables):
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_id") % 5
    west = F.col("ts").cast("timestamp") - F.expr("INTERVAL 4 HOURS")
    text = (
        F.when(kind == 0, F.concat(F.date_format(west, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" -0400")))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == 2, F.date_format(ts, "MM/dd/yyyy hh:mm a"))
        .when(kind == 3, F.concat(F.date_format(west, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-04:00")))
        .otherwise(F.unix_timestamp(ts).cast("string"))
    )
    return t["events"].select("event_id", dates.epoch(text).alias("epoch"))


@query("epoch_format", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown,
    strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d') AS eastern FROM events""")
def epoch_format(t: Tables):
    s = F.unix_timestamp(F.col("ts").cast("timestamp"))
    mixed = F.when(F.col("event_id") % 2 == 0, s * 1000 + 7).otherwise(s)
    return t["events"].select(
        "event_id",
        dates.format_epoch(mixed, "yyyy-MM-dd HH:mm:ss").alias("shown"),
        dates.format_epoch(mixed, "yyyy-MM-dd", "America/New_York").alias("eastern"),
    )


@query("time_features", """SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 AS INTEGER) AS minute_of_day,
    CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week FROM events""")
def time_features(t: Tables):
    s = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return t["events"].select(
        "event_id", dates.minute_of_day(s).alias("minute_of_day"), dates.day_of_week(s).alias("day_of_week")
    )
