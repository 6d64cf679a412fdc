"""Table schemas, their unique keys, and the shapes of the incoming feeds."""

from __future__ import annotations

# Feed shapes as the publishers define them.
OBSERVATION = (
    "struct<start:string,end:string,val:string,accn:string,fy:int,"
    "fp:string,form:string,filed:string,frame:string>"
)
CONCEPT = f"struct<units:map<string,array<{OBSERVATION}>>>"
COMPANY_FACTS = f"cik string, entityName string, facts map<string,map<string,{CONCEPT}>>"
FILING_COLUMNS = [
    "accessionNumber", "filingDate", "reportDate", "acceptanceDateTime", "act", "form",
    "fileNumber", "filmNumber", "items", "core_type", "size", "isXBRL", "isInlineXBRL",
    "primaryDocument", "primaryDocDescription",
]
ADDRESS_COLUMNS = [
    "street1", "street2", "city", "stateOrCountry", "zipCode", "stateOrCountryDescription",
]
COMPANY_TEXT_COLUMNS = [
    "name", "description", "website", "investorWebsite", "category", "fiscalYearEnd",
    "stateOfIncorporation", "stateOfIncorporationDescription", "ein", "entityType",
    "sicDescription", "ownerOrg", "phone", "flags",
]
COMPANY_FLAG_COLUMNS = ["insiderTransactionForOwnerExists", "insiderTransactionForIssuerExists"]
FILING_TYPES = {"size": "bigint", "isXBRL": "int", "isInlineXBRL": "int"}
_ADDRESS = "struct<" + ",".join(f"{c}:string" for c in ADDRESS_COLUMNS) + ">"
_RECENT = "struct<" + ",".join(
    f"{c}:array<{FILING_TYPES.get(c, 'string')}>" for c in FILING_COLUMNS
) + ">"
SUBMISSIONS = ", ".join(
    ["cik string"]
    + [f"{c} string" for c in COMPANY_TEXT_COLUMNS]
    + [f"{c} boolean" for c in COMPANY_FLAG_COLUMNS]
    + [
        "tickers array<string>",
        "exchanges array<string>",
        "formerNames array<struct<name:string,`from`:string,`to`:string>>",
        f"addresses struct<mailing:{_ADDRESS},business:{_ADDRESS}>",
        f"filings struct<recent:{_RECENT}>",
    ]
)
TICKER_LIST = "map<string,struct<cik_str:string,ticker:string,title:string>>"
_NAMED = "array<struct<name:string>>"
ARTICLE = (
    "id bigint, author string, created string, updated string, title string, teaser string, "
    f"body string, url string, image array<struct<size:string,url:string>>, channels {_NAMED}, "
    f"stocks {_NAMED}, tags {_NAMED}"
)
WEBHOOK = (
    "id string, api_version string, kind string, data struct<action:string,id:bigint,"
    "content:struct<id:bigint,revision_id:bigint,type:string,created_at:string,updated_at:string,"
    "title:string,body:string,authors:array<string>,teaser:string,url:string,tags:array<string>,"
    "securities:array<struct<symbol:string,exchange:string,`primary`:boolean>>,"
    "channels:array<string>>,timestamp:string>"
)
PRICE_HISTORY = (
    "symbol string, empty boolean, candles array<struct<open:double,high:double,low:double,"
    "close:double,volume:bigint,datetime:bigint>>"
)
MARKET_HOURS = (
    "equity struct<EQ:struct<date:string,isOpen:boolean,sessionHours:struct<"
    "regularMarket:array<struct<start:string,`end`:string>>>>>"
)

_FACT = (
    "cik string, accn string, fy int, form string, end date, filed date, "
    "val bigint, fp string, frame string"
)
TABLES = {
    "symbols": "cik_str string, ticker string, title string",
    "company_meta": "cik string, "
    + ", ".join(f"{c} string" for c in COMPANY_TEXT_COLUMNS)
    + ", "
    + ", ".join(f"{c} boolean" for c in COMPANY_FLAG_COLUMNS)
    + ", tickers string, exchanges string, formerNames string",
    "addresses": "cik string, kind string, " + ", ".join(f"{c} string" for c in ADDRESS_COLUMNS),
    "company_filings": "cik string, accessionNumber string, filingDate date, reportDate date, "
    "acceptanceDateTime timestamp, act string, form string, fileNumber string, filmNumber string, "
    "items string, core_type string, size bigint, isXBRL boolean, isInlineXBRL boolean, "
    "primaryDocument string, primaryDocDescription string",
    "shares_outstanding": _FACT,
    "stock_float": _FACT + ", currency string",
    "accounting": "cik string, taxonomy string, type string, unit string, start date, end date, "
    "val bigint, accn string, fy int, fp string, form string, filed date, frame string",
    "technicals": "ticker string, datetime bigint, open double, high double, low double, "
    "close double, volume bigint",
    "fundamentals_artifacts": "cik string, accessionNumber string, filename string, uri string, "
    "reportDate date, acceptanceDateTime timestamp, primaryDocDescription string, "
    "rawContent string, cleanContent array<struct<path:string,level:int,key:string,value:string>>",
    "news": "id bigint, ticker string, author string, title string, teaser string, body string, "
    "channels array<string>, tags array<string>, stocks array<string>, "
    "created bigint, updated bigint",
    "text_embeddings": "id bigint, title string, body string, embedding array<float>",
    "filing_vectors": "cik string, accessionNumber string, uri string, chunk int, "
    "content string, content_vector array<float>",
    "screener": "symbol string, market_cap bigint, country string, sector string, industry string",
}

KEYS = {
    "symbols": ["cik_str"],
    "company_meta": ["cik", "ein"],
    "addresses": ["cik", "kind"],
    "company_filings": ["cik", "accessionNumber"],
    "shares_outstanding": ["cik", "accn", "fy", "form"],
    "stock_float": ["cik", "accn", "fy", "form"],
    "accounting": [
        "cik", "taxonomy", "type", "unit", "start", "end", "accn", "fy", "fp", "form", "frame",
    ],
    "technicals": ["ticker", "datetime"],
    "fundamentals_artifacts": ["accessionNumber", "filename"],
    "news": ["id", "ticker"],
    "text_embeddings": ["id"],
    "filing_vectors": ["accessionNumber", "chunk"],
    "screener": ["symbol"],
}
LEGACY_ACCOUNTING_KEY = ["cik", "end", "fy"]
