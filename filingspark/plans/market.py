"""Registered queries over candles, news, features and the price-move model."""

from __future__ import annotations

from pyspark.sql import functions as F

from filingspark.functions import dates
from filingspark.operators import candles as P
from filingspark.operators import companies as C
from filingspark.operators import features as N
from filingspark.operators import flatten, query as Q, stats
from filingspark.operators import keys as K
from filingspark.plans import model
from filingspark.plans.proxies import Tables, sql
from filingspark.plans.registry import query
from filingspark.session import scratch
from filingspark.sources import feeds
from filingspark.streaming import loads

START = 1704153600  # 2024-01-02
NOW = 1707955200  # 2024-02-15
HALF_DAY = 12 * 3600
WEEK = 7 * 24 * 3600


@query("candle_flatten", sql(
    "SELECT ticker, datetime, open, high, low, close, volume FROM candles_raw WHERE seq % 7 <> 0",
    "candles_raw"))
def candle_flatten(t: Tables):
    candle = F.struct(
        "open", "high", "low", "close", "volume",
        (F.col("datetime") * 1000 + 5).alias("datetime"),
    )
    reply = F.struct(
        F.col("ticker").alias("symbol"),
        (F.col("seq") % 7 == 0).alias("empty"),
        F.when(F.col("seq") % 7 != 0, F.array(candle)).otherwise(F.array()).alias("candles"),
    )
    return feeds.price_history(t.candles_raw().select(F.to_json(reply).alias("content")))


@query("market_hours", sql(
    """SELECT day::VARCHAR AS day, is_open, CASE WHEN is_open THEN start ELSE -1 END AS start FROM sessions""",
    "sessions"))
def market_hours(t: Tables):
    def stamp(c):
        local = F.timestamp_seconds(F.col(c) - 5 * 3600)
        return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00"))

    session = F.array(F.struct(stamp("start").alias("start"), stamp("end").alias("end")))
    eq = F.struct(
        F.col("is_open").alias("isOpen"), F.struct(session.alias("regularMarket")).alias("sessionHours")
    )
    reply = F.when(F.col("is_open"), F.to_json(F.struct(F.struct(eq.alias("EQ")).alias("equity"))))
    closed = F.lit('{"equity":{"equity":{"isOpen":false}}}')
    days = t.sessions().select("day", F.coalesce(reply, closed).alias("content"))
    hours = feeds.market_hours(days)
    return hours.select("day", "is_open", F.coalesce("start", F.lit(-1)).alias("start"))


def _landed_articles(t: Tables):
    def rfc(c):
        stamp = F.date_format(F.timestamp_seconds(c), "EEE, dd MMM yyyy HH:mm:ss")
        return F.concat(stamp, F.lit(" +0000")).alias(c)

    def named(c):
        return F.transform(c, lambda x: F.struct(x.alias("name"))).alias(c)

    image = F.array(F.struct(F.lit("thumb").alias("size"), F.concat(F.lit("u"), "id").alias("url")))
    return t.articles().select(
        "id", "author", rfc("created"), rfc("updated"), "title", "teaser", "body",
        F.concat(F.lit("https://news/"), "id").alias("url"), image.alias("image"),
        named("channels"), named("stocks"), named("tags"),
    )


@query("news_scan", sql("SELECT id, title, author, len(stocks) AS n_stocks FROM articles", "articles"))
def news_scan(t: Tables):
    path = scratch(t.spark, "news")
    _landed_articles(t).write.json(path)
    scanned = feeds.news_pages(t.spark, path, lines=True)
    return scanned.select("id", "title", "author", F.size("stocks").cast("bigint").alias("n_stocks"))


@query("webhook_scan", sql(
    """SELECT id, created, title, author, body, stocks[1] AS first_stock, channels[1] AS channel
    FROM articles""", "articles"))
def webhook_scan(t: Tables):
    iso = F.date_format(F.timestamp_seconds("created"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    securities = F.transform(
        "stocks", lambda s: F.struct(s.alias("symbol"), F.lit("NYSE").alias("exchange"), F.lit(True).alias("primary"))
    )
    content = F.struct(
        "id", iso.alias("created_at"), iso.alias("updated_at"), "title", "body",
        F.array("author").alias("authors"), "teaser", "tags", securities.alias("securities"), "channels",
    )
    envelope = t.articles().select(
        F.sha2(F.col("id").cast("string"), 256).alias("id"), F.lit("News/v1").alias("kind"),
        F.struct(F.lit("Created").alias("action"), content.alias("content")).alias("data"),
    )
    path = scratch(t.spark, "webhook")
    envelope.write.json(path)
    rows = feeds.news_webhooks(t.spark, path, lines=True)
    return rows.select(
        "id", "created", "title", "author", "body",
        F.get("stocks", F.lit(0)).alias("first_stock"), F.get("channels", F.lit(0)).alias("channel"),
    )


@query("webhook_apply", sql(
    """SELECT id, CASE WHEN id % 5 = 1 THEN upper(author) ELSE author END AS author,
        CASE WHEN id % 5 = 1 THEN updated + 20 ELSE updated END AS updated FROM articles WHERE id % 5 <> 0""", "articles"))
def webhook_apply(t: Tables):
    """Events that remove every fifth article and replace the next one twice."""
    stored = t.articles().select("id", "author", "updated")
    replaced = F.when(F.col("id") % 5 == 1, F.upper("author")).otherwise(F.col("author"))
    action = F.when(F.col("id") % 5 == 0, "Removed").otherwise("Updated")
    events = stored.where("id % 5 < 2").withColumn("wait", F.explode(F.array(F.lit(10), F.lit(20))))
    hooks = events.select("id", replaced.alias("author"), (F.col("updated") + F.col("wait")).alias("updated"), action.alias("action"))
    return feeds.apply_webhooks(stored, hooks)


@query("article_normalise", sql(
    """SELECT id, author, created, updated, title, teaser, body, array_to_string(channels, ',') AS channels,
    array_to_string(stocks, ',') AS stocks FROM articles""", "articles"))
def article_normalise(t: Tables):
    rows = flatten.normalise_articles(_landed_articles(t)).drop("tags")
    return rows.withColumns({c: F.array_join(c, ",") for c in ("channels", "stocks")})


@query("article_children", sql(
    """SELECT id, 'stocks' AS kind, unnest(range(len(stocks)))::INTEGER AS pos, unnest(stocks) AS name FROM articles
    UNION ALL SELECT id, 'channels', 0, channels[1] FROM articles
    UNION ALL SELECT id, 'tags', 0, tags[1] FROM articles""", "articles"))
def article_children(t: Tables):
    return flatten.article_children(t.articles(), ["stocks", "channels", "tags"])


@query("ticker_search", sql(
    """SELECT id, ticker, created, title FROM articles WHERE ticker = 'T3'
    AND created BETWEEN 1704067200 AND 1709251200 ORDER BY created DESC, id""", "articles"))
def ticker_search(t: Tables):
    hits = Q.ticker_search(t.articles(), "T3", "created", "eq", [1704067200, 1709251200])
    return hits.select("id", "ticker", "created", "title")


@query("news_feed", sql(
    """SELECT id, created, updated, author, title, teaser FROM articles
    WHERE (list_contains(stocks, 'T1') OR list_contains(stocks, 'T2') OR list_contains(stocks, 'T5'))
    AND (contains(lower(title), 'the') OR len(list_filter(tags, lambda x: contains(x, 'the'))) > 0
        OR contains(lower(body), 'the'))
    ORDER BY CASE WHEN contains(lower(title), 'the') THEN 1 ELSE 3 END, created DESC, id
    LIMIT 10 OFFSET 10""", "articles"))
def news_feed(t: Tables):
    return Q.news_feed(
        t.articles(), "abstract", tickers=["T1", "T2", "T5"], topics=["the"], page=1, page_size=10
    )


@query("focused_articles", sql(
    "SELECT id, ticker, created FROM articles WHERE list_contains(stocks, ticker) AND len(stocks) <= 3",
    "articles"))
def focused_articles(t: Tables):
    return Q.focused_articles(t.articles()).select("id", "ticker", "created")


@query("price_history", sql(
    "SELECT ticker, datetime, open, high, low, close, volume FROM candles WHERE ticker = 'T7'", "candles"))
def price_history(t: Tables):
    return Q.price_history(t.candles(), "T7")


@query("stale_tickers", sql(
    """SELECT ticker FROM companies WHERE ticker NOT IN (SELECT ticker FROM candles_raw WHERE datetime >
    (SELECT max(start) FROM sessions WHERE is_open AND day < (SELECT max(day) FROM sessions)))""",
    "companies", "candles_raw", "sessions"))
def stale_tickers(t: Tables):
    sessions = t.sessions()
    last = P.last_session(sessions, sessions.agg(F.max("day")).scalar()).select("start").scalar()
    return C.stale_keys(t.companies(), t.candles_raw(), "ticker", "datetime", last)


@query("screener_enrich", sql(
    """SELECT a.id, a.ticker, coalesce(market_cap, -9) AS market_cap, country, sector, industry FROM articles a
    LEFT JOIN (SELECT * FROM screener WHERE market_cap > 0) s ON s.symbol = a.ticker""",
    "articles", "screener"))
def screener_enrich(t: Tables):
    screener = t.screener().where("market_cap > 0")
    enriched = C.screener_enrich(t.articles().select("id", "ticker"), screener)
    return enriched.withColumn("market_cap", F.coalesce("market_cap", F.lit(-9)))


_LABELS = """priced AS (SELECT a.id, a.ticker, a.created, min(c.datetime) AS open_at,
        arg_min(c.open, c.datetime) AS open, max(c.high) AS high, min(c.low) AS low,
        arg_max(c.close, c.datetime) AS close
    FROM articles a LEFT JOIN candles c ON c.ticker = a.ticker
        AND c.datetime > a.created + 60 AND c.datetime <= a.created + 86400
    GROUP BY a.id, a.ticker, a.created),
labels AS (SELECT id, ticker, created, {cases} FROM priced)"""


def _case(price: str, name: str, gap: int) -> str:
    change = f"({price} - open) / open"
    return f"""CASE WHEN open_at IS NULL OR open_at - created > {gap} OR open = 0 THEN -1
        WHEN {change} > 0.5 THEN 2 WHEN {change} < -0.5 THEN 0 ELSE 1 END AS {name}"""


def _labels(gap: int) -> str:
    cases = [_case(p, n, gap) for p, n in (("high", "max_gain_24"), ("close", "day_gain_24"), ("low", "max_loss_24"))]
    return ",\n" + _LABELS.format(cases=", ".join(cases))


def _sql(extra: str, body: str, *views: str) -> str:
    """Named views, then the common tables in ``extra``, then ``body``."""
    return sql("", *views).rstrip() + extra + "\n" + body


@query("asof_open", _sql(
    _labels(HALF_DAY),
    """SELECT id, open_at, open, high, low, close FROM priced WHERE open_at IS NOT NULL""",
    "articles", "candles"))
def asof_open(t: Tables):
    events = t.articles().select("id", "ticker", "created")
    priced = N.window_prices(events, t.candles()).where("open_at IS NOT NULL")
    return priced.select("id", "open_at", "open", "high", "low", "close")


@query("news_price_labels", _sql(
    _labels(HALF_DAY), "SELECT id, ticker, created, max_gain_24, day_gain_24, max_loss_24 FROM labels",
    "articles", "candles"))
def news_price_labels(t: Tables):
    events = t.articles().select("id", "ticker", "created")
    return N.price_labels(events, t.candles(), max_gap=HALF_DAY)


@query("news_price_labels_20min", _sql(
    _labels(1200), "SELECT id, ticker, created, max_gain_24, day_gain_24, max_loss_24 FROM labels",
    "articles", "candles"))
def news_price_labels_20min(t: Tables):
    return N.price_labels(t.articles().select("id", "ticker", "created"), t.candles())


_TREND = """,
trend AS (SELECT a.id, CASE WHEN median(c.volume) = 0 THEN NULL ELSE
        median(CASE WHEN c.datetime > a.created - 86400 THEN c.volume END) / median(c.volume) END AS volume_trend
    FROM articles a LEFT JOIN candles c ON c.ticker = a.ticker
        AND c.datetime > a.created - 604800 AND c.datetime <= a.created GROUP BY a.id)"""


@query("volume_trend", _sql(
    _TREND, "SELECT id, coalesce(volume_trend, -1) AS volume_trend FROM trend", "articles", "candles"))
def volume_trend(t: Tables):
    events = t.articles().select("id", "ticker", "created")
    trend = N.volume_trend(events, t.candles(), short=86400, long=WEEK)
    return trend.select("id", F.coalesce("volume_trend", F.lit(-1.0)).alias("volume_trend"))


def _features(t: Tables):
    return N.labelled_articles(
        t.articles(), t.candles(), t.screener(), START, max_gap=HALF_DAY, short=86400, long=WEEK
    )


_FEATURES = _labels(HALF_DAY) + _TREND + f""",
features AS (SELECT a.id, a.ticker, a.author, a.created, coalesce(a.title, '') AS title, max_gain_24,
        day_gain_24, max_loss_24, coalesce(volume_trend, -1) AS volume_trend,
        CAST(isodow(to_timestamp(a.created) AT TIME ZONE 'UTC') - 1 AS INTEGER) AS day_of_week,
        coalesce(market_cap, -9) AS market_cap, country, sector, industry
    FROM articles a JOIN labels USING (id) JOIN trend USING (id)
    JOIN (SELECT ticker, max(datetime) - 86400 AS last FROM candles GROUP BY 1) m ON m.ticker = a.ticker
    LEFT JOIN screener ON symbol = a.ticker
    WHERE list_contains(stocks, a.ticker) AND len(stocks) <= 3 AND a.created >= {START} AND a.created <= last)"""


@query("feature_table", _sql(_FEATURES, "SELECT * FROM features", "articles", "candles", "screener"))
def feature_table(t: Tables):
    return _features(t).withColumns(
        {
            "volume_trend": F.coalesce("volume_trend", F.lit(-1.0)),
            "market_cap": F.coalesce("market_cap", F.lit(-9)),
        }
    )


@query("label_counts", _sql(
    _labels(HALF_DAY),
    """SELECT horizon, label, count(*) FILTER (WHERE v = code) AS n FROM (
        SELECT unnest(['max_gain_24', 'day_gain_24', 'max_loss_24']) AS horizon,
            unnest([max_gain_24, day_gain_24, max_loss_24]) AS v FROM labels),
        (VALUES ('positive', 2), ('neutral', 1), ('negative', 0)) AS k(label, code)
    GROUP BY horizon, label""", "articles", "candles"))
def label_counts(t: Tables):
    events = t.articles().select("id", "ticker", "created")
    return stats.label_counts(N.price_labels(events, t.candles(), max_gap=HALF_DAY))


@query("group_split", sql(
    """SELECT id, ticker, CASE WHEN CAST('0x' || substr(md5('0' || ticker), 1, 8) AS BIGINT) % 100 < 80
    THEN 'train' ELSE 'test' END AS split FROM articles""", "articles"))
def group_split(t: Tables):
    return N.group_split(t.articles().select("id", "ticker"), "ticker")


@query("ticker_freshness", sql(
    """SELECT count(DISTINCT ticker) AS total, count(DISTINCT CASE WHEN datetime >
    (SELECT max(datetime) - 86400 FROM candles_raw) THEN ticker END) AS fresh FROM candles_raw""",
    "candles_raw"))
def ticker_freshness(t: Tables):
    candles = t.candles_raw()
    since = candles.agg(F.max("datetime") - 86400).scalar()
    return stats.ticker_freshness(candles, since)


@query("high_watermark", sql(
    """SELECT c.ticker, coalesce(max(datetime), 1735689600) AS latest FROM companies c
    LEFT JOIN candles_raw r ON r.ticker = c.ticker GROUP BY c.ticker""", "companies", "candles_raw"))
def high_watermark(t: Tables):
    return stats.high_watermark(t.companies(), t.candles_raw(), "ticker", "datetime", 1735689600)


@query("duplicate_ids", """SELECT source AS ticker, md5(text) AS id, count(*) AS n FROM documents
    GROUP BY ALL HAVING count(*) >= 2""")
def duplicate_ids(t: Tables):
    documents = t["documents"].select(F.col("source").alias("ticker"), F.md5("text").alias("id"))
    return stats.duplicate_ids(documents, "ticker", "id")


_RESAMPLE = """SELECT '{name}' AS frequency, ticker, {start} AS datetime, arg_min(open, datetime) AS open,
    max(high) AS high, min(low) AS low, arg_max(close, datetime) AS close, CAST(sum(volume) AS BIGINT) AS volume
    FROM candles GROUP BY ALL"""
_STARTS = {
    "minute5": "datetime - datetime % 300",
    "minute30": "datetime - datetime % 1800",
    **{n: f"CAST(epoch(date_trunc('{u}', make_timestamp(datetime * 1000000))) AS BIGINT)" for n, u in P.CALENDAR.items()},
}


@query("candle_resample", sql(
    "\nUNION ALL ".join(
        _RESAMPLE.format(name=n, start=s) for n, s in _STARTS.items()
    ), "candles"))
def candle_resample(t: Tables):
    candles, parts = t.candles(), []
    for name in _STARTS:
        if name.startswith("minute"):
            coarse = P.resample(candles, "minute", int(name[6:]))
        else:
            coarse = P.resample(candles, name)
        parts.append(coarse.withColumn("frequency", F.lit(name)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("latest_quote", sql(
    """SELECT ticker, datetime, open, high, low, close, volume FROM candles
    QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY datetime DESC) = 1""", "candles"))
def latest_quote(t: Tables):
    return P.latest_quote(t.candles())


@query("latest_article", sql(
    """SELECT ticker, id, created, title FROM articles
    QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY created DESC, id DESC) = 1""", "articles"))
def latest_article(t: Tables):
    rows = t.articles().select("ticker", "id", "created", "title")
    return K.last_wins(rows, ["ticker"], ["created", "id"])


@query("previous_close", sql(
    """SELECT ticker, datetime, close, coalesce(lag(close) OVER (PARTITION BY ticker ORDER BY datetime), -1)
        AS previous_close FROM (SELECT ticker, datetime // 86400 * 86400 AS datetime,
        arg_max(close, c.datetime) AS close FROM candles c GROUP BY ALL)""", "candles"))
def previous_close(t: Tables):
    rows = P.previous_close(P.resample(t.candles(), "daily"))
    return rows.select("ticker", "datetime", "close", F.coalesce("previous_close", F.lit(-1.0)).alias("previous_close"))


@query("regular_session", sql(
    """SELECT ticker, c.datetime, close, s.day IS NOT NULL AS regular FROM candles c LEFT JOIN sessions s
    ON s.is_open AND c.datetime BETWEEN s.start AND s."end" """, "candles", "sessions"))
def regular_session(t: Tables):
    candles, sessions = t.candles().select("ticker", "datetime", "close"), t.sessions()
    inside = P.by_session(candles, sessions).withColumn("regular", F.lit(True))
    return inside.unionByName(P.by_session(candles, sessions, extended=True).withColumn("regular", F.lit(False)))


@query("last_session", sql(
    """SELECT day::VARCHAR AS day, start FROM sessions WHERE is_open AND day < (SELECT max(day) FROM sessions)
    ORDER BY day DESC LIMIT 1""", "sessions"))
def last_session(t: Tables):
    sessions = t.sessions()
    return P.last_session(sessions, sessions.agg(F.max("day")).scalar())


@query("backfill_windows", sql(
    f"""SELECT ticker, block::INTEGER AS block, from_s, to_s FROM (
        SELECT ticker, generate_subscripts(edges, 1) - 1 AS block, unnest(edges) AS from_s,
            unnest(list_append(edges[2:], NULL)) AS to_s FROM (
            SELECT ticker, CASE WHEN {NOW} - latest < {WEEK} THEN [latest, {NOW}] ELSE
                list_append(range(latest, {NOW} + 1, ({NOW} - latest) // greatest(({NOW} - latest) // {WEEK}, 1)), {NOW})
                END AS edges FROM (SELECT ticker, max(datetime) AS latest FROM candles_raw GROUP BY 1)))
    WHERE to_s > from_s""", "candles_raw"))
def backfill_windows(t: Tables):
    latest = t.candles_raw().groupBy("ticker").agg(F.max("datetime").alias("latest"))
    return P.backfill_windows(latest, "ticker", "latest", F.lit(NOW).cast("bigint"))


@query("incremental_fresh", sql(
    """SELECT a.id, a.ticker, a.created FROM articles a LEFT JOIN (SELECT ticker, max(created) AS latest
    FROM articles WHERE created < 1704153600 GROUP BY 1) w ON w.ticker = a.ticker
    WHERE a.created > coalesce(latest, 1577836800)""", "articles"))
def incremental_fresh(t: Tables):
    articles = t.articles().select("id", "ticker", "created")
    stored = articles.where("created < 1704153600")
    marks = stats.high_watermark(articles, stored, "ticker", "created", 1577836800)
    return loads.fresh_rows(articles, marks, "ticker", "created")


@query("confusion", """SELECT quality AS truth, toxic AS prediction, count(*) AS n,
    count(*) / any_value(total) AS share FROM labels
    JOIN (SELECT quality, count(*) AS total FROM labels GROUP BY 1) USING (quality) GROUP BY quality, toxic""")
def confusion(t: Tables):
    return model.confusion(t["labels"], "quality", "toxic")


@query("scaler", """WITH v AS (SELECT vec_id % 5 = 0 AS held_out, embedding[1]::DOUBLE AS x FROM embeddings),
    f AS (SELECT avg(x) AS m, stddev_samp(x) AS s FROM v WHERE NOT held_out)
    SELECT held_out, round(avg((x - m) / s) + 0, 6) AS mean, round(var_samp((x - m) / s), 6) AS variance
    FROM v, f GROUP BY held_out""")
def scaler(t: Tables):
    """Mean and variance of the first dimension after scaling fitted on four fifths of the vectors."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    held = (F.col("vec_id") % 5 == 0).alias("held_out")
    rows = t["embeddings"].select(held, array_to_vector("embedding").alias("unit"))
    fitted = model.scaler().fit(rows.where("not held_out"))
    first = F.get(vector_to_array("features"), F.lit(0))
    return fitted.transform(rows).groupBy("held_out").agg(
        (F.round(F.avg(first), 6) + 0.0).alias("mean"), F.round(F.var_samp(first), 6).alias("variance")
    )


@query("scaler_all", """WITH v AS (SELECT vec_id, vec_id % 5 = 0 AS held_out,
        unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS dimension FROM embeddings),
    f AS (SELECT dimension, avg(x) AS m, stddev_samp(x) AS s FROM v WHERE NOT held_out GROUP BY 1)
    SELECT held_out, dimension::INTEGER AS dimension, round(avg((x - m) / s) + 0, 6) AS mean,
        round(var_samp((x - m) / s), 6) AS variance, round(max((x - m) / s), 6) AS most
    FROM v JOIN f USING (dimension) GROUP BY held_out, dimension""")
def scaler_all(t: Tables):
    """All dimensions after scaling fitted on four fifths of the vectors."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    held = (F.col("vec_id") % 5 == 0).alias("held_out")
    rows = t["embeddings"].select(held, array_to_vector("embedding").alias("unit"))
    fitted = model.scaler().fit(rows.where("not held_out"))
    each = fitted.transform(rows).select("held_out", F.posexplode(vector_to_array("features")).alias("dimension", "x"))
    return each.groupBy("held_out", "dimension").agg(
        (F.round(F.avg("x"), 6) + 0.0).alias("mean"), F.round(F.var_samp("x"), 6).alias("variance"),
        F.round(F.max("x"), 6).alias("most"),
    )


@query("price_model", _sql(
    _FEATURES, """SELECT day_gain_24 AS truth, count(*) AS n, true AS judged FROM features
    WHERE day_gain_24 IN (0, 1, 2) AND ('0x' || substr(md5('0' || ticker), 1, 8))::BIGINT % 100 >= 80
    GROUP BY day_gain_24""", "articles", "candles", "screener"))
def price_model(t: Tables):
    """The price-move model, fitted on the titles of the feature table, on the held-out tickers.

    A row per true class: its held-out rows, and whether the confusion rows of the model
    account for all of them.
    """
    split = N.group_split(_features(t).select("id", "ticker", "title", "day_gain_24"), "ticker")
    path = scratch(t.spark, "split")
    split.write.parquet(path)  # read by every stage of the model
    rows = t.spark.read.parquet(path)
    fitted = model.fit_classifier(rows.where("split = 'train'"), "title", "day_gain_24", rounds=30)
    judged = model.predict(fitted, rows.where("split = 'test'")).withColumn("prediction", F.col("prediction").cast("int"))
    table = model.confusion(judged, "day_gain_24", "prediction")
    return table.groupBy("truth").agg(
        F.sum("n").alias("n"),
        ((F.abs(F.sum("share") - 1) < 1e-9) & F.bool_and(F.col("prediction").isin(0, 1, 2))).alias("judged"),
    )


@query("classifier", sql(
    """SELECT CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS truth, count(*) AS n, true AS better
    FROM labels JOIN documents USING (doc_id) WHERE doc_id % 5 = 0 GROUP BY truth"""))
def classifier(t: Tables):
    """Rows per class held out, and whether the model beats always naming the larger class."""
    labelled = t["labels"].join(t["documents"], "doc_id").select(
        "doc_id", "text", F.col("quality").cast("int").alias("quality")
    )
    fitted = model.fit_classifier(labelled.where("doc_id % 5 <> 0"), "text", "quality", rounds=30)
    judged = model.predict(fitted, labelled.where("doc_id % 5 = 0"), "quality")
    per = judged.groupBy("quality").agg(
        F.count("*").alias("n"), F.count_if(F.col("label") == F.col("prediction")).alias("right")
    )
    better = per.agg((F.sum("right") >= F.max("n")).alias("better")).scalar()
    truth = F.when(F.col("quality") == 1, "good").otherwise("poor")
    return per.select(truth.alias("truth"), "n", better.alias("better"))
