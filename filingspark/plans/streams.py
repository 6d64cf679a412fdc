"""Registered queries that run as streams over landed files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingspark.operators import features as N
from filingspark.operators import flatten
from filingspark.plans.market import HALF_DAY, _labels, _sql
from filingspark.plans.proxies import Tables, sql
from filingspark.plans.registry import query
from filingspark.session import scratch
from filingspark.sources import archives, feeds
from filingspark.streaming import candles as live
from filingspark.streaming import feeds as fed
from filingspark.streaming import loads

_LANDED = "archive string, entry string, content string"
_FACT_KEY = ["cik", "accn", "fy", "form"]


def _land(t: Tables, objects=None) -> str:
    """Archive, scan and land the company objects as a stream source, an archive going once it has landed."""
    zipped, landed = scratch(t.spark, "zip"), scratch(t.spark, "landed")
    for wave in archives.write_waves(t.facts_json() if objects is None else objects, zipped):
        found = archives.zip_scan(t.spark, wave).coalesce(t.spark.sparkContext.defaultParallelism)  # few, large files
        loads.land(found, landed, mode="append")
    return landed


def _load_shares(t: Tables, landed: str, target: str) -> None:
    """Load with offsets of its own, as a stream that has lost them does."""
    stream, state = loads.read_landed(t.spark, landed, _LANDED, 8), scratch(t.spark, "state")

    def shares(batch):
        facts = feeds.company_facts(batch, only=flatten.SHARES_ONLY)
        return flatten.shares_outstanding(facts).select(*_FACT_KEY, "val", "end")

    own = loads.stream_id(t.spark, state)
    load = loads.insert_ignore_batches(target, _FACT_KEY, ["end", "val"], shares, own)
    loads.run_available(stream, state, load)


def _load_tables(t: Tables, objects, feed) -> str:
    """Load every table of a feed and return the folder they are in."""
    parse, targets = feed
    root, state = scratch(t.spark, "tables"), scratch(t.spark, "state")
    load = loads.load_tables(root, parse, targets(), loads.stream_id(t.spark, state))
    loads.run_available(loads.read_landed(t.spark, _land(t, objects), _LANDED, 8), state, load)
    return root


def _sums(t: Tables, root: str, name: str, *measures) -> DataFrame:
    rows = loads.loaded(t.spark, f"{root}/{name}")
    values = [m.cast("bigint") for m in measures] or [F.lit(0).cast("bigint")]
    return rows.agg(
        F.lit(name).alias("name"), F.count("*").alias("n"),
        F.coalesce(F.sum(sum(values, F.lit(0).cast("bigint"))), F.lit(0)).alias("total"),
    )


@query("stream_land", sql("SELECT count(*) AS n FROM facts", "facts"))
def stream_land(t: Tables):
    landed, target = _land(t), scratch(t.spark, "copied")
    stream = loads.read_landed(t.spark, landed, _LANDED, 8)
    loads.run_append(stream.select("entry"), target, scratch(t.spark, "state"))
    return t.spark.read.parquet(target).agg(F.count("*").alias("n"))


@query("stream_equals_batch", sql(
    """SELECT cik, accn, fy, form, true AS held FROM facts GROUP BY ALL""", "facts"))
def stream_equals_batch(t: Tables):
    """Each key once, holding the value and date of one of its observations."""
    target = scratch(t.spark, "shares")
    _load_shares(t, _land(t), target)
    seen = t.facts().select(*_FACT_KEY, F.col("quantity").cast("bigint").alias("val"), "end").distinct()
    rows = loads.loaded(t.spark, target).join(seen.withColumn("held", F.lit(True)), [*_FACT_KEY, "val", "end"], "left")
    return rows.select(*_FACT_KEY, F.coalesce("held", F.lit(False)).alias("held"))


@query("stream_facts_tables", sql(
    """SELECT 'shares_outstanding' AS name, count(DISTINCT (cik, accn, fy, form)) AS n FROM facts
    UNION ALL SELECT 'stock_float', count(DISTINCT (cik, accn, fy, form)) FROM facts
    UNION ALL SELECT 'accounting', count(*) * 2 FROM facts""", "facts"))
def stream_facts_tables(t: Tables):
    """Without a start in any observation no accounting key is whole, so all of them stay."""
    root = _load_tables(t, t.facts_json(), fed.FACTS)
    each = [_sums(t, root, name) for name in fed.facts_targets()]
    return reduce(DataFrame.unionByName, each).select("name", "n")


@query("stream_submissions_tables", sql(
    """SELECT 'company_filings' AS name, count(*) * 2 AS n, sum(size)::BIGINT * 2 AS total FROM filings
        JOIN companies USING (cik)
    UNION ALL SELECT 'company_meta', count(*), 0 FROM filings JOIN companies USING (cik)
    UNION ALL SELECT 'addresses', count(DISTINCT cik) * 2, 0 FROM filings JOIN companies USING (cik)""",
    "filings", "companies"))
def stream_submissions_tables(t: Tables):
    root = _load_tables(t, t.submissions_json(), fed.SUBMISSIONS)
    return (
        _sums(t, root, "company_filings", F.col("size"))
        .unionByName(_sums(t, root, "company_meta"))
        .unionByName(_sums(t, root, "addresses"))
    )


@query("restart", sql("SELECT count(DISTINCT (cik, accn, fy, form)) AS n FROM facts", "facts"))
def restart(t: Tables):
    """Two runs with lost offsets between them: the second adds no row."""
    landed, target = _land(t), scratch(t.spark, "shares")
    _load_shares(t, landed, target)
    first = loads.loaded(t.spark, target).count()
    _load_shares(t, landed, target)
    rows = loads.loaded(t.spark, target)
    return rows.agg(F.count("*").alias("n")).where(F.col("n") == first)


@query("batch_skip", sql(
    """SELECT cik, accn, count(*) AS n FROM facts WHERE accn NOT IN
    (SELECT accn FROM facts WHERE filed < (SELECT max(filed) - 365 FROM facts)) GROUP BY ALL""", "facts"))
def batch_skip(t: Tables):
    facts = t.facts()
    cut = facts.agg(F.date_sub(F.max("filed"), 365)).scalar()
    stored = facts.where(F.col("filed") < cut).select("accn")
    return loads.skip_loaded(facts, stored).groupBy("cik", "accn").agg(F.count("*").alias("n"))


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(t: Tables):
    schema = t["events"].schema
    stream = loads.read_landed(t.spark, t.dir, schema, pattern="events.parquet")
    unique = loads.dedupe_stream(stream.select("user_id", "event_type"), ["user_id", "event_type"])
    target = scratch(t.spark, "unique")
    loads.run_append(unique, target, scratch(t.spark, "state"))
    return t.spark.read.parquet(target)


LATENESS = 600
_CUT = 1704153600


def _in_slices(t: Tables, feeds: dict[str, tuple[DataFrame, str]], edges: list[int], start) -> None:
    """Land each feed's rows slice by slice of its time column, and run the stream after each.

    ``start`` gets the landed streams by name. Every run is a restart that goes on from the
    offsets and the state of the one before.
    """
    folders = {name: scratch(t.spark, name) for name in feeds}
    for low, high in zip([None, *edges], [*edges, None]):
        for name, (rows, time) in feeds.items():
            at = F.col(time)
            part = (at >= low if low is not None else F.lit(True)) & (at < high if high is not None else F.lit(True))
            rows.where(part).write.mode("append").parquet(folders[name])
        start({
            name: loads.read_landed(t.spark, folders[name], rows.schema, 1_000_000)
            for name, (rows, _) in feeds.items()
        })


def _thirds(rows: DataFrame, time: str) -> list[int]:
    low, high = rows.agg(F.min(time), F.max(time)).first()
    return [] if low is None else [low + (high - low) * i // 3 for i in (1, 2)]


@query("stream_resample", sql(
    f"""SELECT ticker, datetime // 1800 * 1800 AS datetime, arg_min(open, c.datetime) AS open, max(high) AS high,
        min(low) AS low, arg_max(close, c.datetime) AS close, sum(volume)::BIGINT AS volume
    FROM candles c GROUP BY 1, 2
    HAVING c.datetime // 1800 * 1800 + 1800 <= (SELECT max(datetime) - {LATENESS} FROM candles)""", "candles"))
def stream_resample(t: Tables):
    """Half-hour candles of the closed windows, over three runs of the stream."""
    candles = t.candles()
    target, state = scratch(t.spark, "coarse"), scratch(t.spark, "state")

    def run(streams):
        coarse = live.resample_stream(streams["candles"], 30, f"{LATENESS} seconds")
        loads.run_append(coarse, target, state)

    _in_slices(t, {"candles": (candles, "datetime")}, _thirds(candles, "datetime"), run)
    return t.spark.read.parquet(target)


_CLOSED = f"""least((SELECT max(datetime) FROM candles), (SELECT max(created) FROM articles)) - {LATENESS + 86400 + 60}"""


@query("stream_labels", _sql(
    _labels(HALF_DAY), f"""SELECT id, ticker, created, max_gain_24, day_gain_24, max_loss_24 FROM labels
    WHERE created < {_CLOSED}""", "articles", "candles"))
def stream_labels(t: Tables):
    """Labels of the articles whose day is over, over three runs of two joined streams."""
    articles, candles = t.articles().select("id", "ticker", "created"), t.candles()
    target, state = scratch(t.spark, "labels"), scratch(t.spark, "state")

    def run(streams):
        labels = live.label_stream(
            streams["articles"], streams["candles"], f"{LATENESS} seconds", max_gap=HALF_DAY
        )
        loads.run_append(labels, target, state)

    feeds = {"articles": (articles, "created"), "candles": (candles, "datetime")}
    _in_slices(t, feeds, _thirds(candles, "datetime"), run)
    last = F.least(candles.agg(F.max("datetime")).scalar(), articles.agg(F.max("created")).scalar())
    found = t.spark.read.parquet(target).select("id", "ticker", "created", *N.LABELS)
    return found.where(F.col("created") < last - (LATENESS + 86400 + 60))


@query("stream_fresh", sql(
    """SELECT a.id, a.ticker, a.created FROM articles a LEFT JOIN (SELECT ticker, max(created) AS latest
    FROM articles WHERE created < 1704153600 GROUP BY 1) w ON w.ticker = a.ticker
    WHERE a.created > coalesce(latest, 1577836800)""", "articles"))
def stream_fresh(t: Tables):
    """What three polls bring that is new, each of which brings all earlier rows again."""
    articles = t.articles().select("id", "ticker", "created")
    high = articles.agg(F.max("created")).first()[0] or _CUT
    landed, target, state = (scratch(t.spark, n) for n in ("polls", "fresh", "state"))
    store = t.spark.conf.get(live.STATE_STORE, None)
    t.spark.conf.set(live.STATE_STORE, live.ROCKSDB)
    try:
        for until in (_CUT, (_CUT + high) // 2, high + 1):
            articles.where(F.col("created") < until).write.mode("append").parquet(landed)
            stream = loads.read_landed(t.spark, landed, articles.schema, 1_000_000)
            loads.run_append(live.fresh_stream(stream, "ticker", "created", 1577836800), target, state)
    finally:
        if store is None:
            t.spark.conf.unset(live.STATE_STORE)
        else:
            t.spark.conf.set(live.STATE_STORE, store)
    return t.spark.read.schema(articles.schema).parquet(target).where(F.col("created") >= _CUT)


@query("stream_dedupe_within", """SELECT DISTINCT user_id, event_type FROM events
    WHERE ts < (SELECT min(ts) + INTERVAL 7 DAY FROM events)""")
def stream_dedupe_within(t: Tables):
    """Pairs of the first week, each once, with state that is dropped when it is ten days old."""
    events = t["events"]
    first = events.agg(F.min("ts").alias("first"))
    week = events.join(F.broadcast(first), F.col("ts") < F.col("first") + F.expr("INTERVAL 7 DAY"))  # one row
    landed, target = scratch(t.spark, "week"), scratch(t.spark, "unique")
    week.select("user_id", "event_type", "ts").write.parquet(landed)
    stream = loads.read_landed(t.spark, landed, "user_id long, event_type string, ts timestamp", 1_000_000)
    unique = loads.dedupe_stream(stream, ["user_id", "event_type"], "ts", "10 days")
    loads.run_append(unique.select("user_id", "event_type"), target, scratch(t.spark, "state"))
    return t.spark.read.parquet(target)
