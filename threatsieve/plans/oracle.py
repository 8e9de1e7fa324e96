"""The same queries as plain SQL for DuckDB, written from the definitions, not from the plans."""

from __future__ import annotations

from threatsieve.functions import constants as C
from threatsieve.plans import fixtures as fx


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _ends_with(column: str, suffixes) -> str:
    return "(" + " OR ".join(f"ends_with({column}, '{s}')" for s in suffixes) + ")"


HITS = """
hits AS MATERIALIZED (
  SELECT e.event_id, e.ts, CASE e.event_id % 8
    WHEN 0 THEN regexp_replace(p.url,'[?#].*$','') || '/app_' || CAST(e.event_id AS VARCHAR) || '.apk'
    WHEN 1 THEN regexp_replace(regexp_replace(p.url,'[?#].*$',''),'^https?://','') || '/setup-1.2.3.4.exe'
    WHEN 2 THEN p.url
    WHEN 3 THEN regexp_replace(p.url,'[?#].*$','') || '/free~movie' || CAST(e.event_id % 50 AS VARCHAR) || 'x7.zip'
    WHEN 4 THEN 'http://dl.example.cn:8080/下载' || CAST(e.event_id % 97 AS VARCHAR) || '.apk'
    WHEN 5 THEN 'http://10.0.0.' || CAST(e.event_id % 256 AS VARCHAR) || '/a.sisx'
    WHEN 6 THEN 'http://bad:port/x.apk'
    ELSE 'https://dup.example.com/same.jar' END AS url
  FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
)"""

HIT_LINES = """
hit_lines AS (
  SELECT event_id, CASE WHEN event_id % 101 = 0 THEN CAST(event_id AS VARCHAR) || '|LTE'
    ELSE CAST(event_id AS VARCHAR) || '|LTE|' || url || '|200' END AS value
  FROM hits
)"""

LISTS = """
white AS (SELECT DISTINCT url FROM hits WHERE event_id % 40 = 0),
black AS (SELECT DISTINCT url FROM hits WHERE event_id % 36 = 4),
listed AS (SELECT url FROM white UNION ALL SELECT url FROM black)"""

LABELLED = """
labelled AS (
  SELECT event_id, url,
    CASE WHEN (event_id % 8 IN (0,4,5)) <> (event_id % 29 = 0) THEN 0 ELSE 1 END AS label
  FROM hits
)"""

VERDICTS = """
verdicts AS (
  SELECT ts, strftime(ts, '%Y%m%d%H') AS batch,
    CASE WHEN url LIKE '%://%' THEN url ELSE 'http://' || url END AS gbdt_url, url AS bayes_url,
    CASE WHEN event_id % 3 <> 0 AND event_id % 8 <> 6 THEN 0 ELSE 1 END AS gbdt_pred,
    CASE WHEN event_id % 4 <> 1 OR event_id % 5 = 0 THEN 0 ELSE 1 END AS bayes_pred,
    CAST(50 + event_id % 50 AS DOUBLE) / 100 AS bayes_prob
  FROM hits
)"""

FUSED = """
fused AS (
  SELECT g.batch, g.gbdt_url AS url, CAST(0.58 AS DOUBLE) AS "prob_GBDT",
    b.bayes_prob AS "prob_Bayes"
  FROM verdicts g JOIN verdicts b ON g.batch = b.batch AND g.gbdt_url = b.bayes_url
  WHERE g.gbdt_pred = 0 AND b.bayes_pred = 0
),
counted AS (
  SELECT batch, url, "prob_GBDT", "prob_Bayes", CAST(count(*) AS VARCHAR) AS copies
  FROM fused GROUP BY batch, url, "prob_GBDT", "prob_Bayes"
)"""


def _parts(source: str, prefix_scheme: bool, carried: str) -> str:
    """URL parts step by step: trim, scheme, authority, host and port."""
    full = "CASE WHEN instr(raw, '://') = 0 THEN 'http://' || raw ELSE raw END" if prefix_scheme else "raw"
    return f"""
p0 AS (SELECT {carried}, {full} AS url FROM {source}),
p1 AS (
  SELECT *, regexp_replace(regexp_replace(url, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'), '^(?i:url:)', '') AS spec
  FROM p0
),
p2 AS (
  SELECT *, lower(regexp_extract(spec, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)) AS scheme,
    regexp_extract(spec, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1) AS auth
  FROM p1
),
p3 AS (
  SELECT *, CASE WHEN scheme = 'mailto' OR length(auth) - length(replace(auth, '@', '')) > 1 THEN ''
    ELSE regexp_replace(auth, '^[^@]*@', '') END AS hp
  FROM p2
),
p4 AS (
  SELECT *, CASE WHEN starts_with(hp, '[') THEN regexp_extract(hp, '^(\\[[^\\[\\]]*\\])', 1)
    ELSE split_part(hp, ':', 1) END AS host
  FROM p3
),
p5 AS (
  SELECT *, CASE WHEN substr(hp, length(host) + 1) IN ('', ':') THEN -1
    WHEN regexp_full_match(substr(hp, length(host) + 1), ':[+-]?[0-9]+')
    THEN TRY_CAST(substr(hp, length(host) + 2) AS INTEGER) END AS port_number
  FROM p4
),
parts AS (
  SELECT *, scheme IN ('http', 'https', 'ftp', 'file', 'mailto')
    AND coalesce(port_number >= -1, false) AS parses, rtrim(host, '.') AS hs
  FROM p5
)"""


def _lexical(carried: str) -> str:
    terms = " + ".join(f"CAST(contains(url, '{t}') AS INTEGER)" for t in C.SENSITIVE_TERMS)
    return f"""
files AS (SELECT *, regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1) AS ef FROM parts),
lexical AS (
  SELECT {carried}, url AS "Url",
    CASE WHEN port_number = -1 THEN 80 ELSE port_number END AS port,
    CAST(len(string_split(hs, '.')) AS INTEGER) AS "domainNameLevels",
    regexp_matches(url, '{C.IPV4_PATTERN}') AS "isIP",
    CAST(length(url) AS INTEGER) AS urllen,
    CAST({terms} AS INTEGER) AS "longTermCount",
    split_part(hs, '.', -1) IN ({_quoted(C.KNOWN_TLDS)}) AS "isDing",
    {_ends_with('url', C.SENSITIVE_SUFFIXES)} AS "is_Prefix_sensitive",
    regexp_matches(ef, '{C.CHINESE_PATTERN}') AS ishaschn,
    CAST(length(ef) AS INTEGER) AS execfile_len,
    CAST(length(ef) - length(regexp_replace(ef, '{C.NUMBER_PATTERN}', '', 'g')) AS INTEGER) AS "Numricinlength"
  FROM files WHERE parses AND (hs <> '' OR host = '')
)"""


_LEXICAL_COLUMNS = (
    '"Url", port, "domainNameLevels", "isIP", urllen, "longTermCount", "isDing", '
    '"is_Prefix_sensitive", ishaschn, execfile_len, "Numricinlength"'
)


def _word(column: str) -> str:
    bare = f"replace(replace({column}, 'http://', ''), 'https://', '')"
    return f"regexp_replace(translate({bare}, '.=&?-@:(', '////////'), '[0-9]+', '', 'g')"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


DOWNLOAD = _ends_with("url", C.DOWNLOAD_SUFFIXES)
RULE = '"is_Prefix_sensitive" AND ("isIP" OR port <> 80)'


def _full(url: str) -> str:
    return f"CASE WHEN instr({url}, '://') = 0 THEN 'http://' || {url} ELSE {url} END"


MET = f"""
met AS (
  SELECT {_full('url')} AS url, count(*) AS copies, count(*) FILTER (instr(url, '://') > 0) AS own_copies
  FROM (SELECT split_part(value, '|', {fx.URL_INDEX + 1}) AS url FROM hit_lines) WHERE {DOWNLOAD} GROUP BY ALL
)"""

REPORT_URLS = """
report_urls AS (
  SELECT DISTINCT url AS raw FROM hits
  WHERE url NOT IN (SELECT url FROM listed) AND ends_with(url, '.apk')
)"""

AREA = (
    f"([{_quoted(C.PROVINCE_CODES)}])"
    f"[CAST(1 + ('0x' || substr(md5(url), 1, 8))::BIGINT % {len(C.PROVINCE_CODES)} AS INTEGER)]"
)

REPORT_ROWS = f"""
report_rows AS (
  SELECT {AREA} AS area,
    '{C.REPORT_DEGREE}' AS degree, host AS domain, url
  FROM parts WHERE parses ORDER BY url LIMIT {fx.REPORT_LIMIT}
)"""

# Multinomial naive Bayes with add-one smoothing, from token counts.
def _bayes(scored: str) -> str:
    """Scores of the URLs of ``scored`` (``url`` and counts), from the labelled rows."""
    return f"""
wd AS (SELECT url AS "Url", {_word('url')} AS "Word", label FROM labelled),
t AS (
  SELECT label, tok FROM (SELECT label, unnest(string_split_regex("Word", '/+')) AS tok FROM wd)
  WHERE tok <> ''
),
v AS (SELECT count(DISTINCT tok) AS v FROM t),
c AS (SELECT label, tok, count(*) AS n FROM t GROUP BY ALL),
n AS (SELECT label, count(*) AS n FROM t GROUP BY ALL),
k AS (
  SELECT label, ln((count(*) + 1.0) / ((SELECT count(*) FROM wd) + 1.0 * (SELECT count(DISTINCT label) FROM wd))) AS pr
  FROM wd GROUP BY ALL
),
th AS (
  SELECT n.label, voc.tok, ln((coalesce(c.n, 0) + 1.0) / (n.n + v.v)) AS lp
  FROM n CROSS JOIN (SELECT DISTINCT tok FROM t) voc CROSS JOIN v
  LEFT JOIN c ON c.label = n.label AND c.tok = voc.tok
),
u AS (SELECT *, {_word('url')} AS "Word" FROM ({scored})),
ut AS (
  SELECT url, tok FROM (SELECT url, unnest(string_split_regex("Word", '/+')) AS tok FROM u)
  WHERE tok <> ''
),
known AS (
  SELECT ut.url, sum(lp) FILTER (th.label = 0) AS s0, sum(lp) FILTER (th.label = 1) AS s1
  FROM ut JOIN th USING (tok) GROUP BY ut.url
),
sc AS (
  SELECT u.*,
    coalesce(s0, 0) + (SELECT pr FROM k WHERE label = 0) AS s0,
    coalesce(s1, 0) + (SELECT pr FROM k WHERE label = 1) AS s1
  FROM u LEFT JOIN known USING (url)
)"""


_DAILY = """, kept AS (SELECT *, {kept} AS kept FROM verdicts),
fused AS (
  SELECT substr(g.batch, 1, 8) AS day, count(*) AS output_count
  FROM kept g JOIN kept b ON g.batch = b.batch AND g.gbdt_url = b.bayes_url
  WHERE g.kept AND b.kept AND g.gbdt_pred = 0 AND b.bayes_pred = 0 GROUP BY ALL
),
stages AS (
  SELECT strftime(ts, '%Y%m%d') AS day, count(*) AS input_count, count(*) FILTER (kept) AS suffix_count,
    count(*) FILTER (kept AND gbdt_pred = 0) AS gbdt_count,
    count(*) FILTER (kept AND bayes_pred = 0) AS bayes_count
  FROM kept GROUP BY ALL
)
SELECT day, input_count, suffix_count, gbdt_count, bayes_count,
  CAST(coalesce(output_count, 0) AS VARCHAR) AS output_count
FROM stages LEFT JOIN fused USING (day)"""


def oracle_sql() -> dict[str, str]:
    """SQL per query name; the tree model's verdicts follow from the rule of the rows it was fitted on."""
    hit_parts = "(SELECT event_id, url AS raw FROM hits) h"
    lexical_hits = (HITS, _parts(hit_parts, True, "event_id"))
    training = "(SELECT label, url AS raw FROM labelled) l"
    reported = (HITS, LISTS, REPORT_URLS, _parts("report_urls", False, "raw"), REPORT_ROWS)
    kept = _ends_with("bayes_url", C.DOWNLOAD_SUFFIXES)
    daily_stats = _with(HITS, VERDICTS) + _DAILY.format(kept=kept)
    return {
        "hit_lines": _with(HITS, HIT_LINES) + "SELECT event_id, value FROM hit_lines",
        "extract_field": _with(HITS, HIT_LINES)
        + f"""SELECT event_id, split_part(value, '|', {fx.URL_INDEX + 1}) AS url FROM hit_lines
WHERE split_part(value, '|', {fx.URL_INDEX + 1}) <> ''""",
        "bad_records": _with(HITS, HIT_LINES)
        + f"""SELECT event_id, value FROM hit_lines
WHERE coalesce(string_split(value, '|')[{fx.URL_INDEX + 1}], '') = ''""",
        "suffix_filter": _with(HITS) + f"SELECT event_id, url FROM hits WHERE {DOWNLOAD}",
        "url_parts": _with(*lexical_hits)
        + """SELECT event_id, url, parses, CASE WHEN parses THEN scheme ELSE '' END AS scheme,
  CASE WHEN parses THEN host ELSE '' END AS host,
  CASE WHEN parses THEN port_number ELSE -1 END AS port_number
FROM parts""",
        "lexical_features": _with(*lexical_hits, _lexical("event_id"))
        + f"SELECT event_id, {_LEXICAL_COLUMNS} FROM lexical",
        "token_text": _with(HITS) + f'SELECT event_id, url AS "Url", {_word("url")} AS "Word" FROM hits',
        "train_lexical": _with(HITS, LABELLED, _parts(training, True, "label"), _lexical("label"))
        + f"SELECT {_LEXICAL_COLUMNS}, label FROM lexical",
        "train_tokens": _with(HITS, LABELLED)
        + f'SELECT url AS "Url", {_word("url")} AS "Word", label FROM labelled',
        "bayes_score": _with(HITS, LABELLED, _bayes(f"SELECT url, count(*) AS copies FROM hits WHERE {DOWNLOAD} GROUP BY url"))
        + """SELECT url AS "url_Bayes", round(1 / (1 + exp(s1 - s0)), 6) AS "prob_Bayes", copies
FROM sc WHERE s0 >= s1""",
        "bayes_model": _with(HITS, LABELLED, _bayes("SELECT NULL AS url WHERE false"))
        + """SELECT tok AS token, label, round(lp, 6) AS log_weight FROM th
UNION ALL SELECT '' AS token, label, round(pr, 6) AS log_weight FROM k""",
        "gbdt_score": _with(
            HITS,
            f"weighed AS (SELECT url AS raw, count(*) AS copies FROM hits WHERE {DOWNLOAD} GROUP BY url)",
            _parts("weighed", True, "copies"), _lexical("copies"),
        )
        + f"""SELECT "Url" AS "url_GBDT", CAST(0.58 AS DOUBLE) AS "prob_GBDT", CAST(copies AS VARCHAR) AS copies
FROM lexical WHERE {RULE}""",
        "score_lines": _with(
            HITS, HIT_LINES, LABELLED, MET, _parts("(SELECT url AS raw FROM met)", False, "raw"),
            _lexical("raw"), _bayes("SELECT * FROM met"),
        )
        + f"""SELECT sc.url, CAST(0.58 AS DOUBLE) AS "prob_GBDT", round(1 / (1 + exp(s1 - s0)), 6) AS "prob_Bayes",
  CAST(copies::HUGEINT * own_copies AS VARCHAR) AS copies
FROM sc JOIN lexical ON lexical.raw = sc.url WHERE s0 >= s1 AND own_copies > 0 AND {RULE}""",
        "fusion_join": _with(HITS, VERDICTS, FUSED)
        + 'SELECT batch, url, "prob_GBDT", "prob_Bayes", copies FROM counted',
        "fusion_normalized": _with(HITS, VERDICTS)
        + """SELECT g.batch, g.gbdt_url AS url, CAST(0.58 AS DOUBLE) AS "prob_GBDT",
  max(b.bayes_prob) AS "prob_Bayes"
FROM (SELECT DISTINCT batch, gbdt_url FROM verdicts WHERE gbdt_pred = 0) g
JOIN (SELECT batch, gbdt_url, bayes_prob FROM verdicts WHERE bayes_pred = 0) b
  ON g.batch = b.batch AND g.gbdt_url = b.gbdt_url
GROUP BY g.batch, g.gbdt_url""",
        "verdict_lines": _with(HITS, VERDICTS, FUSED)
        + """SELECT batch, copies,
  url || '|0.58|' || CAST("prob_Bayes" AS VARCHAR) AS line
FROM counted""",
        "dedup_urls": _with(HITS) + "SELECT DISTINCT url FROM hits",
        "list_union": _with(HITS, LISTS) + "SELECT url FROM listed",
        "exclude_listed": _with(HITS, LISTS)
        + "SELECT DISTINCT url FROM hits WHERE url NOT IN (SELECT url FROM listed)",
        "stream_whitelist": _with(HITS, LISTS)
        + f"""SELECT {_full('url')} AS url, count(*) AS copies, count(*) FILTER (instr(url, '://') > 0) AS own_copies
FROM hits WHERE {DOWNLOAD} AND {_full('url')} NOT IN (SELECT {_full('url')} FROM white) GROUP BY ALL""",
        "package_urls": _with(HITS) + "SELECT DISTINCT url FROM hits WHERE ends_with(url, '.apk')",
        "funnel_counts": _with(HITS, LISTS)
        + """, distinct_urls AS (
  SELECT url, url NOT IN (SELECT url FROM listed) AND ends_with(url, '.apk') AS in_result, count(*) AS n
  FROM hits GROUP BY url
)
SELECT CAST(sum(n) AS BIGINT) AS input_count, CAST(sum(n) AS BIGINT) - count(*) AS duplicate_count,
  count(*) AS dedup_count, count(*) - count(*) FILTER (in_result) AS filtered_count,
  count(*) FILTER (in_result) AS result_count
FROM distinct_urls""",
        "daily_stats": daily_stats,
        "stream_daily_stats": daily_stats,
        "stream_unique_urls": _with(HITS) + "SELECT DISTINCT strftime(ts, '%Y%m%d') AS day, url FROM hits",
        "date_stamps": _with(HITS)
        + """SELECT event_id, strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y%m%d%H%M%S') AS second,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS readable
FROM hits""",
        "province_codes": _with(HITS) + f"SELECT event_id, {AREA} AS area FROM hits",
        "report_rows": _with(*reported) + "SELECT area, degree, domain, url FROM report_rows",
        "report_json": _with(*reported)
        + f"""SELECT CAST(to_json({{'date': '{fx.REPORT_TIME:%Y-%m-%d %H:%M:%S}',
  'size': (SELECT least(count(*), {fx.REPORT_LIMIT}) FROM report_urls),
  'list': list({{'area': area, 'degree': degree, 'domain': domain, 'url': url}} ORDER BY url)}}) AS VARCHAR) AS report
FROM report_rows""",
    }
