"""The feeds of the domain as views over the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingspark.operators.keys import first_wins

DEALT_ROWS = 20_000


def _epoch(ts: str) -> Column:
    return F.unix_timestamp(F.col(ts).cast("timestamp"))


def _ticker(c: str | Column) -> Column:
    return F.concat(F.lit("T"), c)


class Tables:
    """Readers of the given parquet tables and of the views derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def dealt(self, name: str, key: str | None = None) -> DataFrame:
        """A table for heavy work per row, in tasks of about ``DEALT_ROWS`` rows.

        A table of enough files is read as it lies; only one that is stored in fewer
        files than it needs tasks is dealt out; given the ``key`` of a join that follows, by
        it, so that a join of two large tables shuffles it no second time.
        """
        rows = self[name]
        tasks = -(-rows.count() // DEALT_ROWS)
        return rows if tasks <= len(rows.inputFiles()) else rows.repartition(tasks, *([key] if key else []))

    def candles_raw(self) -> DataFrame:
        value = F.col("value")
        return self["events"].select(
            _ticker("user_id").alias("ticker"),
            _epoch("ts").alias("datetime"),
            F.col("event_id").alias("seq"),
            value.alias("open"),
            (value * 1.01).alias("high"),
            (value * 0.99).alias("low"),
            value.alias("close"),
            (F.col("event_id") % 1000 + 1).alias("volume"),
        )

    def candles(self) -> DataFrame:
        """One candle per ticker and second."""
        return first_wins(self.candles_raw(), ["ticker", "datetime"], ["seq"], False).drop("seq")

    def articles(self) -> DataFrame:
        d, e = self["documents"], self["events"].select("event_id", "ts", "user_id")
        joined = d.join(e, d["doc_id"] == e["event_id"])
        offsets = F.sequence(F.lit(0), (F.col("doc_id") % 5).cast("int"))
        return joined.select(
            F.col("doc_id").alias("id"),
            _ticker("user_id").alias("ticker"),
            _epoch("ts").alias("created"),
            (_epoch("ts") + 60 * (F.col("doc_id") % 3)).alias("updated"),
            F.concat(F.lit("desk "), F.col("doc_id") % 7).alias("author"),
            F.substring_index("text", "\n", 1).alias("title"),
            F.substring_index("text", ". ", 1).alias("teaser"),
            F.col("text").alias("body"),
            F.array("source").alias("channels"),
            F.array("lang").alias("tags"),
            F.transform(offsets, lambda i: _ticker(F.col("user_id") + i)).alias("stocks"),
        )

    def companies(self) -> DataFrame:
        nation = self["nation"].select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return self["customer"].join(nation, "c_nationkey").select(
            F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("cik"),
            _ticker("c_custkey").alias("ticker"),
            F.col("c_name").alias("title"),
            F.col("c_acctbal").alias("market_cap"),
            F.col("c_mktsegment").alias("sector"),
            F.col("n_name").alias("country"),
        )

    def screener(self) -> DataFrame:
        return self.companies().select(
            F.col("ticker").alias("symbol"),
            F.floor("market_cap").cast("bigint").alias("market_cap"),
            "country",
            "sector",
            F.col("title").alias("industry"),
        )

    def filings(self, how: str = "plain") -> DataFrame:
        key = F.col("o_orderkey").cast("string")
        orders = self.dealt("orders") if how == "dealt" else self["orders"]
        return orders.select(
            F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"),
            F.concat(F.lpad(key, 10, "0"), F.lit("-24-000001")).alias("accessionNumber"),
            F.col("o_orderpriority").alias("form"),
            F.col("o_orderdate").cast("date").alias("filingDate"),
            F.concat(F.lit("d"), key, F.lit(".htm")).alias("primaryDocument"),
            F.floor("o_totalprice").cast("bigint").alias("size"),
        )

    def facts(self) -> DataFrame:
        rows = self.dealt("lineitem", "l_orderkey").join(
            self["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"),
            "l_orderkey",
        )
        key = F.col("l_orderkey").cast("string")
        year = F.year("o_orderdate")
        return rows.select(
            F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"),
            F.col("l_returnflag").alias("type"),
            F.col("l_linestatus").alias("unit"),
            F.col("l_shipdate").cast("date").alias("end"),
            F.col("l_extendedprice").alias("val"),
            F.col("l_quantity").alias("quantity"),
            F.concat(F.lpad(key, 10, "0"), F.lit("-24-000001")).alias("accn"),
            year.alias("fy"),
            F.lit("FY").alias("fp"),
            F.lit("10-K/A").alias("form"),
            F.col("o_orderdate").cast("date").alias("filed"),
            F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("CY"), year.cast("string"))).alias("frame"),
        )

    def facts_json(self) -> DataFrame:
        """One company-facts object per line item, in the published shape."""

        def seen(val: Column) -> Column:
            return F.array(
                F.struct("end", val.alias("val"), "accn", "fy", "fp", "form", "filed", "frame")
            )

        def concept(*units: Column) -> Column:
            return F.struct(F.create_map(*units).alias("units"))

        dei = F.create_map(
            F.lit("EntityCommonStockSharesOutstanding"),
            concept(F.lit("shares"), seen(F.col("quantity"))),
            F.lit("EntityPublicFloat"),
            concept(F.lit("USD"), seen(F.col("val")), F.lit("EUR"), seen(F.col("val") * 2)),
        )
        gaap = F.create_map(
            F.col("type"),
            concept(F.col("unit"), seen(F.col("val")), F.lit("USD/shares"), seen(F.col("quantity"))),
        )
        body = F.struct(
            F.col("cik").cast("bigint").alias("cik"),
            F.col("cik").alias("entityName"),
            F.create_map(F.lit("dei"), dei, F.lit("us-gaap"), gaap).alias("facts"),
        )
        objects = self.facts().select("cik", "accn", F.to_json(body).alias("content"))
        return objects.select(F.concat_ws("-", "cik", "accn", F.md5("content")).alias("entry"), "content")

    def submissions_json(self) -> DataFrame:
        """One submissions object per order, its filings listed as parallel arrays of two."""
        c = self.companies()
        f = self.filings("dealt").withColumnRenamed("cik", "f_cik")
        joined = f.join(c, f["f_cik"] == c["cik"])

        def both(col: str | Column, second: Column | None = None) -> Column:
            one = F.col(col) if isinstance(col, str) else col
            return F.array(one, one if second is None else second)

        second = F.replace("accessionNumber", F.lit("-24-000001"), F.lit("-24-000002"))
        empty = both(F.lit(""))
        recent = F.struct(
            both("accessionNumber", second).alias("accessionNumber"),
            both("filingDate").alias("filingDate"),
            both("filingDate").alias("reportDate"),
            both(F.concat(F.col("filingDate").cast("string"), F.lit("T16:30:00.000Z"))).alias("acceptanceDateTime"),
            both(F.lit("34")).alias("act"),
            both("form", F.lit("10-K/A")).alias("form"),
            *[empty.alias(n) for n in ("fileNumber", "filmNumber", "items", "core_type")],
            both("size").alias("size"),
            both(F.lit(1), F.lit(0)).alias("isXBRL"),
            both(F.lit(0)).alias("isInlineXBRL"),
            both("primaryDocument").alias("primaryDocument"),
            both(F.lit("FORM")).alias("primaryDocDescription"),
        )

        def address(kind: str) -> Column:
            return F.struct(
                F.concat(F.lit(kind + " "), "title").alias("street1"),
                F.lit("").alias("street2"),
                F.col("country").alias("city"),
                F.col("country").alias("stateOrCountry"),
                F.substring("cik", 6, 5).alias("zipCode"),
                F.col("country").alias("stateOrCountryDescription"),
            )

        body = F.struct(
            F.col("cik"),
            F.col("title").alias("name"),
            F.array("ticker").alias("tickers"),
            F.array(F.lit("NYSE"), F.col("sector")).alias("exchanges"),
            F.col("sector").alias("sicDescription"),
            F.col("accessionNumber").alias("ein"),
            F.lit(True).alias("insiderTransactionForOwnerExists"),
            F.lit(False).alias("insiderTransactionForIssuerExists"),
            F.array(
                F.struct(F.concat(F.lit("Old "), "title").alias("name"), F.lit("2001").alias("from"), F.lit("2002").alias("to"))
            ).alias("formerNames"),
            F.struct(address("M").alias("mailing"), address("B").alias("business")).alias("addresses"),
            F.struct(recent.alias("recent")).alias("filings"),
        )
        return joined.select(F.col("accessionNumber").alias("entry"), F.to_json(body).alias("content"))

    def headers(self) -> DataFrame:
        """A tab-indented header per supplier, with a repeated former name."""
        n = self["nation"].select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        lines = F.concat_ws(
            "\n",
            F.lit("FILER:"),
            F.lit(""),
            F.lit("\tCOMPANY DATA:"),
            F.concat(F.lit("\t\tCOMPANY CONFORMED NAME:\t\t\t"), "s_name"),
            F.concat(F.lit("\t\tSTATE:\t"), "n_name"),
            F.lit("\tFORMER COMPANY:"),
            F.concat(F.lit("\t\tFORMER CONFORMED NAME:\tOld "), "s_name"),
            F.lit("\tFORMER COMPANY:"),
            F.concat(F.lit("\t\tFORMER CONFORMED NAME:\tOlder "), "s_name"),
            F.lit("no colon here"),
        )
        return self["supplier"].join(n, "s_nationkey").select(
            F.col("s_suppkey").alias("doc"), lines.alias("text")
        )

    def sessions(self) -> DataFrame:
        """Each date with events; open from Monday to Friday, 14:30 to 21:00."""
        day = F.col("ts").cast("date")
        days = self["events"].select(day.alias("day")).distinct()
        midnight = F.unix_timestamp(F.col("day").cast("timestamp"))
        return days.select(
            "day",
            (F.weekday("day") < 5).alias("is_open"),
            (midnight + 52_200).alias("start"),
            (midnight + 75_600).alias("end"),
        )

    def gazetteer(self) -> DataFrame:
        """Long words of the benchmark texts, and neighbouring words of some length, by label."""
        words = F.split(F.lower("text"), r"[^\p{L}\p{N}]+")
        listed = self["benchmark"].select(words.alias("w"))
        single = listed.select(F.explode("w").alias("name")).where(F.length("name") >= 9)
        two = F.zip_with("w", F.slice("w", F.lit(2), F.size("w")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        pairs = listed.select(F.inline(two)).where("length(a) >= 5 and length(b) >= 5")
        return single.distinct().withColumn("label", F.lit("TERM")).unionByName(
            pairs.select(F.concat_ws(" ", "a", "b").alias("name")).distinct().withColumn("label", F.lit("PAIR"))
        )


CTE = {
    "candles_raw": """SELECT 'T' || user_id AS ticker, CAST(floor(epoch(ts)) AS BIGINT) AS datetime,
        event_id AS seq, value AS open, value * 1.01 AS high, value * 0.99 AS low,
        value AS close, event_id % 1000 + 1 AS volume FROM events""",
    "candles": """SELECT * EXCLUDE (seq) FROM candles_raw
        QUALIFY row_number() OVER (PARTITION BY ticker, datetime ORDER BY seq) = 1""",
    "articles": """SELECT d.doc_id AS id, 'T' || e.user_id AS ticker,
        CAST(floor(epoch(e.ts)) AS BIGINT) AS created,
        CAST(floor(epoch(e.ts)) AS BIGINT) + 60 * (d.doc_id % 3) AS updated,
        'desk ' || (d.doc_id % 7) AS author, split_part(d.text, chr(10), 1) AS title,
        split_part(d.text, '. ', 1) AS teaser, d.text AS body, [d.source] AS channels,
        [d.lang] AS tags,
        list_transform(range(d.doc_id % 5 + 1), lambda i: 'T' || (e.user_id + i)) AS stocks
        FROM documents d JOIN events e ON e.event_id = d.doc_id""",
    "companies": """SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, 'T' || c_custkey AS ticker,
        c_name AS title, c_acctbal AS market_cap, c_mktsegment AS sector, n_name AS country
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "screener": """SELECT ticker AS symbol, CAST(floor(market_cap) AS BIGINT) AS market_cap, country,
        sector, title AS industry FROM companies""",
    "filings": """SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
        lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-24-000001' AS accessionNumber,
        o_orderpriority AS form, CAST(o_orderdate AS DATE) AS filingDate,
        'd' || o_orderkey || '.htm' AS primaryDocument,
        CAST(floor(o_totalprice) AS BIGINT) AS size FROM orders""",
    "facts": """SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, l_returnflag AS type,
        l_linestatus AS unit, CAST(l_shipdate AS DATE) AS "end", l_extendedprice AS val,
        l_quantity AS quantity, lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '-24-000001' AS accn,
        CAST(year(o_orderdate) AS INTEGER) AS fy, 'FY' AS fp, '10-K/A' AS form,
        CAST(o_orderdate AS DATE) AS filed,
        CASE WHEN l_linenumber % 2 = 0 THEN 'CY' || year(o_orderdate) ELSE '' END AS frame
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "sessions": """SELECT DISTINCT CAST(ts AS DATE) AS day, isodow(ts) <= 5 AS is_open,
        CAST(epoch(CAST(ts AS DATE)) AS BIGINT) + 52200 AS start,
        CAST(epoch(CAST(ts AS DATE)) AS BIGINT) + 75600 AS "end" FROM events""",
    "gazetteer": """SELECT DISTINCT name, 'TERM' AS label FROM (SELECT unnest(regexp_split_to_array(
        lower(text), '[^\\p{L}\\p{N}]+')) AS name FROM benchmark) WHERE length(name) >= 9
        UNION ALL SELECT DISTINCT a || ' ' || b, 'PAIR' FROM (SELECT unnest(w) AS a,
            unnest(list_append(w[2:], NULL)) AS b FROM (SELECT regexp_split_to_array(lower(text),
            '[^\\p{L}\\p{N}]+') AS w FROM benchmark)) WHERE length(a) >= 5 AND length(b) >= 5""",
}
_NEEDS = {"candles": ["candles_raw"], "screener": ["companies"]}


def sql(body: str, *views: str) -> str:
    """``body`` with the named views, and those they need, in front."""
    names: list[str] = []
    for view in views:
        names += [n for n in [*_NEEDS.get(view, []), view] if n not in names]
    ctes = ",\n".join(f"{n} AS ({CTE[n]})" for n in names)
    return f"WITH {ctes}\n{body}" if ctes else body
