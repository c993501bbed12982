"""The same queries as :mod:`sitegauge.registry`, written as DuckDB SQL over
the driver's tables (``region nation customer supplier part orders lineitem
pages``), for the side-by-side correctness check.

The SQL is written independently of the Spark code; only parameters are
shared (run dates, thresholds, fixed value lists), so a
mistake in a Spark operator shows up as a mismatch.
"""

from __future__ import annotations

from sitegauge.functions.calendar import reporting_calendar
from sitegauge.functions.columns import MISSING_PRICE_TOKENS
from sitegauge.plans.scorecard import SKIP_REGION
from sitegauge.sources.schemas import QUESTIONS, VENDORS
from sitegauge.sources.standins import (ANSWER_CODES, CUSTOMER_RUN_DATE, HASH_MODULUS,
                                        HASH_MULTIPLIER, LOYALTY_SHARE, PREMIUM_PRIORITIES,
                                        SKIPPED_REGION_NAME, SUPPLIER_RUN_DATE,
                                        UNASSIGNED_NATION_KEY)

AVG_DIGITS = 9


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def title(expr: str) -> str:
    """Python ``str.title()`` then ``strip()``."""
    runs = f"regexp_extract_all(lower({expr}), '(\\p{{L}}+|\\P{{L}}+)', 1)"
    return (f"trim(array_to_string(list_transform({runs}, "
            f"lambda r: upper(substr(r, 1, 1)) || substr(r, 2)), ''))")


def ieee(n: str, d: str) -> str:
    n, d = f"CAST({n} AS DOUBLE)", f"CAST({d} AS DOUBLE)"
    return (f"(CASE WHEN {d} <> 0 THEN {n} / {d} "
            f"WHEN {d} = 0 AND {n} > 0 THEN CAST('inf' AS DOUBLE) "
            f"WHEN {d} = 0 AND {n} < 0 THEN CAST('-inf' AS DOUBLE) END)")


def rnd(expr: str) -> str:
    return f"round({expr}, {AVG_DIGITS})"


def decode(expr: str) -> str:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "\u00a9"),
                    ("&middot;", "\u00b7"), ("&amp;", "&")):
        expr = f"replace({expr}, {q(ent)}, {q(ch)})"
    return expr


# The given pages' own mark-up: what precedes each part, and how the text after
# it ends. Split by strings, not by the patterns of the Spark side.
PAGE_PARTS = {
    "ad": ('<div class="ad">', "split_part(x, '<', 1)"),
    "nav": ("<li><a ", "split_part(split_part(x, '>', 2), '<', 1)"),
    "heading": ("<h1>", "split_part(x, '<', 1)"),
}


_FIRST, _HREF = "split_part(x, '<', 1)", "split_part(x, '\"', 1)"
_LINKED = "contains(" + _HREF + ", 'th')"
# Marks, texts, and which pieces count, of further selections.
CONTAINS_PARTS = {
    "part_of_class": ('<div class="ad">', _FIRST, "true"),
    "link": ('<a href="', "split_part(split_part(x, '>', 2), '<', 1)", _LINKED),
    "target": ('<a href="', _HREF, _LINKED),
    "item_link": ('<li><a href="', _HREF, "true"),
}
BODY_PARTS = {
    "paragraph": ("<p>", _FIRST, "true"), "bold": ("<b>", _FIRST, "true"),
    "bold_in_paragraph": ("<p><b>", _FIRST, "true"), "footer": ("<footer>", _FIRST, "true"),
    "article": ("<article>", _FIRST, "true"),
}


def pieces(mark: str, text: str, counts: str = "true") -> str:
    return (f"list_filter(list_transform(list_filter(list_slice(string_split(html, {q(mark)}), 2, 1000000000), "
            f"lambda x: {counts}), lambda x: {text}), lambda x: x <> '')")


def part_rows(parts: dict) -> str:
    """One row per page, kind and position."""
    return " UNION ALL ".join(
        f"SELECT page_id, {q(kind)} AS kind, pos, {decode('t[pos + 1]')} AS text FROM (SELECT page_id, t, "
        f"unnest(range(len(t))) AS pos FROM (SELECT page_id, {pieces(*part)} AS t FROM pages) a) b" for kind, part in parts.items())


# --- stand-in worlds ---------------------------------------------------------

def _answers(h: str) -> str:
    cols = []
    for k, name in enumerate(QUESTIONS):
        code = f"(({h} >> {2 * k}) % 4)"
        cases = " ".join(f"WHEN {code} = {i} THEN {q(a)}" for i, a in enumerate(ANSWER_CODES))
        cols.append(f"CASE {cases} END AS {name.lower()}")
    return ", ".join(cols)


def world_ctes(w: str) -> list[str]:
    """CTEs ``{w}_roster, {w}_sites, {w}_vol, {w}_loy, {w}_survey,
    {w}_assign, {w}_totals, {w}_pairs, {w}_kpis, {w}_scored, {w}_win``."""
    if w == "customer":
        run, base, key, nkey, bal = CUSTOMER_RUN_DATE, "customer", "c_custkey", "c_nationkey", "c_acctbal"
        owner, address = "c_mktsegment", "c_name"
        facts = "orders"
        f_site, f_ts, f_amt = "o_custkey", "o_orderdate", "o_totalprice"
        premium = f"o_orderpriority IN ({', '.join(q(p) for p in PREMIUM_PRIORITIES)})"
        loyal = "o_orderstatus = 'F'"
        seed = "min(o_orderkey)"
    else:
        run, base, key, nkey, bal = SUPPLIER_RUN_DATE, "supplier", "s_suppkey", "s_nationkey", "s_acctbal"
        owner, address = "n_name", "s_name"
        facts = "lineitem"
        f_site, f_ts, f_amt = "l_suppkey", "l_shipdate", "l_extendedprice"
        premium = "l_returnflag = 'R'"
        loyal = "l_linestatus = 'F'"
        seed = "min(l_orderkey * 8 + l_linenumber)"
    cal = reporting_calendar(run)
    money = f"CAST({f_amt} AS DECIMAL(18,2))"
    h = f"((({w}_seed.seed % {HASH_MODULUS}) * {HASH_MULTIPLIER}) % {HASH_MODULUS})"
    waves = f"(CAST(year({f_ts}) AS VARCHAR) || CAST((month({f_ts}) + 3) // 4 AS VARCHAR))"
    p = w + "_"
    ctes = [
        f"""{p}geo AS (SELECT b.*, n.n_name, r.r_name FROM {base} b
            JOIN nation n ON b.{nkey} = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)""",
        f"""{p}roster_raw AS (SELECT CAST({key} AS VARCHAR) AS site_id, r_name AS region, n_name AS district
            FROM {p}geo WHERE {bal} >= 0)""",
        f"""{p}roster AS (SELECT site_id, {title('region')} AS region, district FROM {p}roster_raw)""",
        f"""{p}hier AS (SELECT CAST({key} AS VARCHAR) AS site_id, {owner} AS owner_name,
            CAST({nkey} AS VARCHAR) AS owner_number, {address} AS address, n_name AS city FROM {p}geo
            WHERE {owner} IS NOT NULL AND {owner} <> '')""",
        f"""{p}sites AS (SELECT r.site_id, r.region, r.district, h.owner_name, h.owner_number, h.address, h.city
            FROM {p}roster r LEFT JOIN {p}hier h ON r.site_id = h.site_id)""",
        f"""{p}vol AS (SELECT CAST({f_site} AS VARCHAR) AS site_id, {f_ts} AS ts, {money} AS volume,
            CASE WHEN {premium} THEN {money} ELSE CAST(0 AS DECIMAL(18,2)) END AS premium_volume FROM {facts})""",
        f"""{p}loy AS (SELECT CAST({f_site} AS VARCHAR) AS site_id, {f_ts} AS ts,
            {money} * CAST({q(LOYALTY_SHARE)} AS DECIMAL(3,2)) AS loyalty_volume FROM {facts} WHERE {loyal})""",
        f"""{p}seed AS (SELECT CAST({f_site} AS VARCHAR) AS site_id, {waves} AS wave_id, {seed} AS seed
            FROM {facts} GROUP BY 1, 2)""",
        f"""{p}survey_raw AS (SELECT {p}seed.site_id, wave_id, g.n_name AS territory_manager,
            g.r_name AS sales_manager, {_answers(h)}, CAST({h} % 101 AS DOUBLE) AS experience_score
            FROM {p}seed LEFT JOIN {p}geo g ON {p}seed.site_id = CAST(g.{key} AS VARCHAR))""",
        _survey_scores(p),
        f"""{p}assign AS (SELECT n_name AS territory_manager,
            CASE WHEN r_name = {q(SKIPPED_REGION_NAME)} THEN {q(SKIP_REGION)} ELSE r_name END AS region
            FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> {UNASSIGNED_NATION_KEY})""",
        f"""{p}monthly_all AS (SELECT site_id, year, month, source, sum(volume) AS volume,
            sum(premium_volume) AS premium_volume, sum(loyalty_volume) AS loyalty_volume, count(*) AS n_rows
            FROM (SELECT site_id, year(ts) AS year, month(ts) AS month, 'volume' AS source, volume, premium_volume,
                         CAST(NULL AS DECIMAL(22,4)) AS loyalty_volume
                  FROM {p}vol WHERE ts >= TIMESTAMP '{cal.volume_start.isoformat()}'
                  UNION ALL
                  SELECT site_id, year(ts), month(ts), 'loyalty', NULL, NULL, loyalty_volume
                  FROM {p}loy WHERE ts >= TIMESTAMP '{cal.loyalty_start.isoformat()}') u
            GROUP BY 1, 2, 3, 4)""",
        f"""{p}monthly AS (SELECT * FROM {p}monthly_all
            WHERE source = 'loyalty' OR site_id IN (SELECT site_id FROM {p}roster_raw))""",
        f"""{p}win AS (SELECT Y, M, M % 4 <> 0 AS is_open,
                   CASE WHEN M % 4 <> 0 THEN M // 4 * 4 ELSE M END AS ppe, (M + 3) // 4 AS label
            FROM (SELECT min(ym) // 100 AS Y, min(ym) % 100 AS M
                  FROM (SELECT source, max(year * 100 + month) AS ym FROM {p}monthly GROUP BY source) l) x)""",
        f"""{p}tagged AS (
            SELECT m.*, m.year AS p_year, (m.month + 3) // 4 AS p_trim, false AS is_ptd, 'cur' AS role
              FROM {p}monthly m, {p}win w WHERE NOT (w.is_open AND m.year = w.Y AND m.month > w.ppe)
            UNION ALL
            SELECT m.*, m.year + 1, (m.month + 3) // 4, false, 'prev'
              FROM {p}monthly m, {p}win w WHERE NOT (w.is_open AND m.year = w.Y AND m.month > w.ppe)
               AND m.year + 1 >= w.Y - 1 AND m.year + 1 <= w.Y
            UNION ALL
            SELECT m.*, m.year, w.label, true, 'cur' FROM {p}monthly m, {p}win w
             WHERE w.is_open AND m.year IN (w.Y - 1, w.Y) AND m.month > w.ppe AND m.month <= w.M
            UNION ALL
            SELECT m.*, w.Y, w.label, true, 'prev' FROM {p}monthly m, {p}win w
             WHERE w.is_open AND m.year = w.Y - 1 AND m.month > w.ppe AND m.month <= w.M)""",
        f"""{p}sums AS (SELECT site_id, p_year AS year, p_trim AS trimester, is_ptd,
            sum(CASE WHEN role = 'cur' THEN volume END) AS volume,
            sum(CASE WHEN role = 'cur' THEN premium_volume END) AS premium_volume,
            sum(CASE WHEN role = 'cur' THEN loyalty_volume END) AS loyalty_volume,
            sum(CASE WHEN role = 'prev' THEN volume END) AS prev_volume,
            sum(CASE WHEN role = 'prev' THEN premium_volume END) AS prev_premium_volume,
            sum(CASE WHEN role = 'cur' AND source = 'volume' THEN n_rows ELSE 0 END) AS n_volume,
            sum(CASE WHEN role = 'cur' AND source = 'loyalty' THEN n_rows ELSE 0 END) AS n_loyalty,
            sum(CASE WHEN role = 'prev' AND source = 'volume' THEN n_rows ELSE 0 END) AS n_prev_volume
            FROM {p}tagged GROUP BY 1, 2, 3, 4)""",
        f"""{p}totals AS (SELECT site_id, CAST(year AS BIGINT) AS year, CAST(trimester AS BIGINT) AS trimester,
            is_ptd,
            CASE WHEN n_volume > 0 THEN CAST(coalesce(volume, 0) AS DOUBLE) END AS volume,
            CASE WHEN n_volume > 0 THEN CAST(coalesce(premium_volume, 0) AS DOUBLE) END AS premium_volume,
            CASE WHEN n_loyalty > 0 THEN CAST(coalesce(loyalty_volume, 0) AS DOUBLE) END AS loyalty_volume,
            CASE WHEN n_prev_volume > 0 THEN CAST(coalesce(prev_volume, 0) AS DOUBLE) END AS prev_volume,
            CASE WHEN n_prev_volume > 0 THEN CAST(coalesce(prev_premium_volume, 0) AS DOUBLE) END
                AS prev_premium_volume,
            n_volume, n_loyalty, volume AS volume_exact
            FROM {p}sums)""",
        f"""{p}present AS (SELECT year, trimester, is_ptd, bool_or(n_volume > 0) AS v, bool_or(n_loyalty > 0) AS l
            FROM {p}totals GROUP BY 1, 2, 3)""",
        f"""{p}cand AS (SELECT CAST(w.Y - 1 + a.yy AS BIGINT) AS year, CAST(b.t AS BIGINT) AS trimester,
                   false AS is_ptd FROM {p}win w, range(0, 2) a(yy), range(1, 4) b(t)
            UNION ALL SELECT w.Y, w.label, true FROM {p}win w WHERE w.is_open)""",
        f"""{p}pairs0 AS (SELECT c.year, c.trimester, c.is_ptd,
            coalesce(pc.v, false) AND coalesce(pp.v, false) AS growth_ok,
            coalesce(pc.v, false) AND coalesce(pp.v, false) AND coalesce(pc.l, false) AS pen_ok
            FROM {p}cand c
            LEFT JOIN {p}present pc ON pc.year = c.year AND pc.trimester = c.trimester AND pc.is_ptd = c.is_ptd
            LEFT JOIN {p}present pp ON pp.year = c.year - 1 AND pp.trimester = c.trimester AND pp.is_ptd = c.is_ptd)""",
        f"""{p}pairs AS (SELECT year, trimester, is_ptd, pen_ok,
            pen_ok AND (CAST(year AS VARCHAR) || CAST(trimester AS VARCHAR))
                IN (SELECT wave_id FROM {p}survey) AS score_ok
            FROM {p}pairs0 WHERE (is_ptd AND growth_ok) OR (NOT is_ptd AND pen_ok))""",
        f"""{p}kpis AS (SELECT s.site_id, s.year, s.trimester, s.is_ptd, s.score_ok,
            {ieee('t.volume', 't.prev_volume')} - 1.0 AS volume_growth,
            {ieee('t.premium_volume', 't.prev_premium_volume')} - 1.0 AS premium_growth,
            CASE WHEN s.pen_ok THEN {ieee('t.loyalty_volume', 't.volume')} END AS penetration
            FROM (SELECT r.site_id, pr.* FROM {p}roster r, {p}pairs pr) s
            LEFT JOIN {p}totals t ON t.site_id = s.site_id AND t.year = s.year AND t.trimester = s.trimester
                 AND t.is_ptd = s.is_ptd)""",
        f"""{p}scored0 AS (SELECT k.*, CAST(k.year AS VARCHAR) || CAST(k.trimester AS VARCHAR) AS wave_id,
            CAST(CASE WHEN k.penetration >= 0.1 THEN 30 WHEN k.penetration >= 0.05 THEN 25 ELSE 0 END AS BIGINT)
                AS penetration_points,
            CAST(CASE WHEN k.volume_growth >= 0.02 THEN 10 ELSE 0 END AS BIGINT) AS volume_points,
            CAST(CASE WHEN k.premium_growth >= 0.035 THEN 20 ELSE 0 END AS BIGINT) AS premium_points,
            s.service_ratio * 20 AS service_points, s.facility_ratio * 20 AS facility_points
            FROM {p}kpis k LEFT JOIN {p}survey s
              ON s.site_id = k.site_id AND s.wave_id = CAST(k.year AS VARCHAR) || CAST(k.trimester AS VARCHAR)
            WHERE k.score_ok)""",
        f"""{p}scored AS (SELECT *, penetration_points + volume_points + premium_points + service_points
            + facility_points AS total FROM {p}scored0)""",
        f"""{p}current AS (SELECT pr.year, pr.trimester, pr.is_ptd FROM {p}pairs pr, {p}win w
            WHERE pr.year = w.Y AND pr.trimester = w.label AND pr.is_ptd = w.is_open AND pr.score_ok)""",
        f"""{p}ranked AS (SELECT s.site_id, si.region, si.owner_name, s.year, s.trimester, s.is_ptd, s.total,
            CASE WHEN si.region IS NOT NULL THEN row_number() OVER (PARTITION BY si.region
                 ORDER BY s.total DESC NULLS LAST, s.site_id) END AS rank
            FROM {p}scored s JOIN {p}current c ON s.year = c.year AND s.trimester = c.trimester
                 AND s.is_ptd = c.is_ptd
            LEFT JOIN {p}sites si ON si.site_id = s.site_id)""",
        f"""{p}owner_avg AS (
            WITH b AS (SELECT s.total, s.wave_id, si.region, si.owner_name FROM {p}scored s
                       LEFT JOIN {p}sites si ON si.site_id = s.site_id
                       WHERE s.year IN ({', '.join(str(y) for y in cal.report_years())})),
                 o AS (SELECT owner_name, region, wave_id, avg(total) AS owner_avg FROM b
                       WHERE owner_name IS NOT NULL AND region IS NOT NULL AND wave_id IS NOT NULL GROUP BY 1, 2, 3),
                 r AS (SELECT region, wave_id, avg(total) AS region_avg FROM b
                       WHERE region IS NOT NULL AND wave_id IS NOT NULL GROUP BY 1, 2)
            SELECT o.region, o.owner_name, o.wave_id, o.owner_avg, r.region_avg
            FROM o LEFT JOIN r ON o.region = r.region AND o.wave_id = r.wave_id)""",
        f"""{p}mvo AS (
            WITH latest AS (SELECT site_id, territory_manager FROM (
                     SELECT site_id, territory_manager,
                            row_number() OVER (PARTITION BY site_id ORDER BY wave_id DESC) AS rn
                     FROM {p}survey) x WHERE rn = 1),
                 site_region AS (SELECT l.site_id, a.region FROM latest l
                     LEFT JOIN {p}assign a ON l.territory_manager IS NOT DISTINCT FROM a.territory_manager),
                 rows AS (SELECT s.site_id, s.wave_id, s.service_ratio, s.facility_ratio, s.experience_score,
                     {title('sr.region')} AS region,
                     CASE WHEN s.site_id IN (SELECT site_id FROM {p}roster) THEN 1 ELSE 0 END AS member
                     FROM {p}survey s LEFT JOIN site_region sr ON sr.site_id = s.site_id
                     WHERE sr.region IS DISTINCT FROM {q(SKIP_REGION)})
            SELECT region, wave_id,
                avg(CASE WHEN member = 1 THEN service_ratio END) AS service_member,
                avg(CASE WHEN member = 0 THEN service_ratio END) AS service_non_member,
                avg(CASE WHEN member = 1 THEN facility_ratio END) AS facility_member,
                avg(CASE WHEN member = 0 THEN facility_ratio END) AS facility_non_member,
                avg(CASE WHEN member = 1 THEN experience_score END) AS experience_member,
                avg(CASE WHEN member = 0 THEN experience_score END) AS experience_non_member
            FROM rows WHERE region IS NOT NULL GROUP BY 1, 2)""",
        f"""{p}owner_survey AS (
            SELECT si.owner_name, si.region, s.wave_id, avg(s.service_ratio) AS service,
                   avg(s.facility_ratio) AS facility, avg(s.experience_score) AS experience
            FROM {p}sites si JOIN {p}survey s ON s.site_id = si.site_id
            WHERE substr(s.wave_id, 1, 4) IN ({', '.join(q(str(y)) for y in cal.report_years())})
              AND si.owner_name IS NOT NULL AND si.region IS NOT NULL
            GROUP BY 1, 2, 3)""",
    ]
    return ctes


def _survey_scores(p: str) -> str:
    def pts(col):
        return f"(CASE {col} WHEN 'Yes' THEN 6 WHEN 'Caution' THEN 3 ELSE 0 END)"

    def miss(col, w):
        return f"(CASE WHEN {col} IS NULL THEN {w} ELSE 0 END)"

    s_num = " + ".join(pts(c) for c in ("q10", "q11", "q12")) + " + (CASE WHEN q18 = 'Yes' THEN 3 ELSE 0 END)"
    s_den = "21 - " + " - ".join(miss(c, 6) for c in ("q10", "q11", "q12"))
    f_num = " + ".join(pts(c) for c in ("q7", "q8", "q9")) + " + (CASE WHEN q14 = 'Yes' THEN 3 ELSE 0 END)"
    f_den = "21 - " + " - ".join(miss(c, 6) for c in ("q7", "q8", "q9")) + " - " + miss("q14", 3)
    return f"""{p}survey AS (SELECT *, {ieee('service_num', 'service_den')} AS service_ratio,
            {ieee('facility_num', 'facility_den')} AS facility_ratio FROM (
            SELECT *, CAST({s_num} AS BIGINT) AS service_num, CAST({s_den} AS BIGINT) AS service_den,
                   CAST({f_num} AS BIGINT) AS facility_num, CAST({f_den} AS BIGINT) AS facility_den
            FROM {p}survey_raw) x)"""


def with_worlds(*worlds: str) -> str:
    ctes = []
    for w in worlds:
        ctes += world_ctes(w)
    return "WITH " + ",\n".join(ctes) + "\n"


def per_world(select: str) -> str:
    """``select`` with ``{w}`` placeholders, run for both worlds."""
    parts = [f"SELECT {q(w)} AS world, * FROM ({select.format(w=w)}) x" for w in ("customer", "supplier")]
    return with_worlds("customer", "supplier") + "\nUNION ALL\n".join(parts)


# --- price history ------------------------------------------------------------

def _price_log() -> str:
    text = "'$' || format('{:,.2f}', l_extendedprice)"
    tokens = ", ".join(q(t) for t in MISSING_PRICE_TOKENS)
    parsed = (f"CASE WHEN trim({text}) IN ({tokens}) THEN NULL "
              f"ELSE TRY_CAST(regexp_replace(trim({text}), '[$,]', '', 'g') AS DOUBLE) END")
    vendors = ", ".join(f"CASE WHEN l_suppkey % {len(VENDORS)} = {i} THEN {parsed} END AS {v}"
                        for i, v in enumerate(VENDORS))
    return (f"SELECT CAST(l_partkey AS VARCHAR) AS product, {vendors}, "
            f"strftime(l_shipdate, '%m/%d/%Y') AS date, l_orderkey, l_linenumber, l_suppkey, "
            f"l_extendedprice FROM lineitem")


def _page_lists() -> str:
    cols = ", ".join(f"{pieces(mark, text)} AS {kind}" for kind, (mark, text) in PAGE_PARTS.items())
    return f"SELECT page_id, {cols} FROM pages"


def _scored_wide() -> str:
    """All measures and slots of both worlds, pivoted by the names in the data."""
    slot = "CAST(s.year AS VARCHAR) || CASE WHEN s.is_ptd THEN 'PTD' ELSE '' END || CAST(s.trimester AS VARCHAR)"
    doubles = {"Volume": "t.volume", "Premium": "t.premium_volume", "Loyalty": "t.loyalty_volume",
               "Volume_Growth": "s.volume_growth", "Premium_Growth": "s.premium_growth", "Loyalty_Pen": "s.penetration",
               "Service_Score": "s.service_points", "Facility_Score": "s.facility_points", "Total_Score": "s.total"}
    longs = {"Loyalty_Pen_Score": "s.penetration_points", "Volume_Score": "s.volume_points", "Premium_Score": "s.premium_points"}

    def long_form(measures: dict) -> str:
        rows = ", ".join(f"({q(n)}, {c})" for n, c in measures.items())
        return " UNION ALL ".join(
            f"""SELECT {q(w)} AS world, s.site_id, m.k || '_' || {slot} AS name, m.v AS v
                FROM {w}_scored s LEFT JOIN {w}_totals t ON t.site_id = s.site_id AND t.year = s.year
                     AND t.trimester = s.trimester AND t.is_ptd = s.is_ptd, LATERAL (VALUES {rows}) m(k, v)"""
            for w in ("customer", "supplier"))

    ranks = " UNION ALL ".join(
        f"SELECT {q(w)}, site_id, 'Rank_' || CAST(year AS VARCHAR) || CAST(trimester AS VARCHAR), rank FROM {w}_ranked"
        for w in ("customer", "supplier"))
    sites = " UNION ALL ".join(f"SELECT {q(w)} AS world, * FROM {w}_sites" for w in ("customer", "supplier"))
    return with_worlds("customer", "supplier")[:-1] + f""", doubles AS ({long_form(doubles)}),
        longs AS ({long_form(longs)} UNION ALL {ranks}), every_site AS ({sites})
        SELECT * FROM every_site
        LEFT JOIN (PIVOT doubles ON name USING max(v) GROUP BY world, site_id) d USING (world, site_id)
        LEFT JOIN (PIVOT longs ON name USING max(v) GROUP BY world, site_id) l USING (world, site_id)"""


def _sql_queries() -> dict[str, str]:
    vend = ", ".join(VENDORS)
    cal_c = reporting_calendar(CUSTOMER_RUN_DATE)
    # waves come from the data, as the columns do
    cells = """SELECT s.site_id, m.k AS metric, w.wave_id AS period, m.k || '_' || w.wave_id AS variable,
            CASE m.k WHEN 'service' THEN c.service_ratio WHEN 'facility' THEN c.facility_ratio
                ELSE c.experience_score END AS value
        FROM (SELECT DISTINCT site_id FROM customer_survey) s CROSS JOIN (SELECT DISTINCT wave_id FROM customer_survey) w
        CROSS JOIN (VALUES ('service'), ('facility'), ('experience')) m(k)
        LEFT JOIN customer_survey c ON c.site_id = s.site_id AND c.wave_id = w.wave_id"""
    cw = with_worlds("customer")
    out = {
        "prices_clean": f"SELECT product, {vend}, date FROM ({_price_log()}) x",
        "prices_dedupe_first": f"""SELECT product, date, {vend} FROM (
            SELECT *, row_number() OVER (PARTITION BY product, date
                ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS rn
            FROM ({_price_log()}) x) y WHERE rn = 1""",
        "pages_class_text": " UNION ALL ".join(
            f"""SELECT page_id, {q(kind)} AS kind, CAST(pos AS BIGINT) AS pos, {decode('t')} AS text FROM (
                SELECT page_id, unnest(range(len({kind}))) AS pos, unnest({kind}) AS t
                FROM ({_page_lists()}) l) u"""
            for kind in PAGE_PARTS),
        "pages_contains": part_rows(CONTAINS_PARTS),
        "pages_body_text": part_rows(BODY_PARTS),
        "lists_zip": f"""SELECT page_id, CAST(pos AS BIGINT) AS pos, {decode('t')} AS text, {decode('h')} AS href FROM (
            SELECT page_id, unnest(range(len(t))) AS pos, unnest(t) AS t, unnest(h) AS h FROM (
              SELECT page_id, {pieces(*PAGE_PARTS["nav"])} AS t,
                     {pieces("<li><a ", "split_part(split_part(x, 'href=" + '"' + "', 2), '" + '"' + "', 1)")} AS h FROM pages) a) b""",
        "layout_union": cw + f"""SELECT site_id, wave_id, territory_manager, sales_manager,
            {', '.join(x.lower() for x in QUESTIONS)}, experience_score FROM customer_survey""",
        "survey_ratios": cw + """SELECT site_id, wave_id, service_num, service_den, service_ratio,
            facility_num, facility_den, facility_ratio FROM customer_survey""",
        "survey_pivot": cw[:-1] + f""", cells AS ({cells})
            SELECT * FROM (PIVOT (SELECT site_id, variable, value FROM cells) ON variable USING max(value) GROUP BY site_id)""",
        "latest_wave": cw + """SELECT site_id, wave_id, territory_manager FROM (
            SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY wave_id DESC) AS rn
            FROM customer_survey) x WHERE rn = 1""",
        "wave_counts": cw + """SELECT wave_id, count(site_id) AS site_id, count(q7) AS q7, count(q8) AS q8,
            count(q9) AS q9, count(q10) AS q10, count(q11) AS q11, count(q12) AS q12, count(q14) AS q14,
            count(q18) AS q18, count(experience_score) AS experience_score
            FROM customer_survey GROUP BY wave_id""",
        "crosstab_counts": cw + "SELECT service_den, " + ", ".join(
            f"count(*) FILTER (WHERE service_num = {v}) AS n_{v}" for v in range(0, 22, 3))
            + " FROM customer_survey GROUP BY service_den",
        "zero_scores": cw + """SELECT site_id, wave_id, service_num, service_den FROM customer_survey
            WHERE service_num = 0""",
        "unpivot_split": cw + cells,
        "pivot_mean": cw[:-1] + f", longt AS ({cells})\n" + f"""
            SELECT r.region, l.period,
                {rnd("avg(CASE WHEN l.metric = 'service' THEN l.value END)")} AS service,
                {rnd("avg(CASE WHEN l.metric = 'facility' THEN l.value END)")} AS facility,
                {rnd("avg(CASE WHEN l.metric = 'experience' THEN l.value END)")} AS experience
            FROM longt l JOIN customer_roster r ON r.site_id = l.site_id
            WHERE l.value IS NOT NULL GROUP BY 1, 2""",
        "volume_semi_sum": cw + f"""SELECT site_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
            CAST(coalesce(sum(volume), 0) AS DOUBLE) AS volume,
            CAST(coalesce(sum(premium_volume), 0) AS DOUBLE) AS premium_volume
            FROM customer_vol WHERE ts >= TIMESTAMP '{cal_c.volume_start.isoformat()}'
              AND site_id IN (SELECT site_id FROM customer_roster_raw)
            GROUP BY site_id, CAST(ts AS DATE)""",
        "loyalty_by_parent": cw + f"""SELECT site_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
            CAST(loyalty_volume AS DOUBLE) AS loyalty_volume FROM customer_loy
            WHERE ts >= TIMESTAMP '{cal_c.loyalty_start.isoformat()}'""",
        "latest_month": with_worlds("customer", "supplier") + " UNION ALL ".join(
            f"""SELECT {q(w)} AS world, {q(src)} AS source, CAST(year(max(ts)) AS BIGINT) AS max_year,
                CAST(month(max(ts)) AS BIGINT) AS max_month FROM {w}_{tbl}
                WHERE ts >= TIMESTAMP '{start}' {extra}"""
            for w, cal in (("customer", cal_c), ("supplier", reporting_calendar(SUPPLIER_RUN_DATE)))
            for src, tbl, start, extra in (
                ("volume", "vol", cal.volume_start.isoformat(),
                 f"AND site_id IN (SELECT site_id FROM {w}_roster_raw)"),
                ("loyalty", "loy", cal.loyalty_start.isoformat(), ""))),
        "period_closed": cw + """SELECT site_id, year, trimester, is_ptd, volume, premium_volume,
            loyalty_volume, prev_volume, prev_premium_volume FROM customer_totals""",
        "period_open": with_worlds("supplier") + """SELECT site_id, year, trimester, is_ptd, volume,
            premium_volume, loyalty_volume, prev_volume, prev_premium_volume FROM supplier_totals""",
        "running_sum": cw + """SELECT site_id, year, trimester, volume,
            CAST(sum(volume_exact) OVER (PARTITION BY site_id ORDER BY year, trimester
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_volume
            FROM customer_totals WHERE NOT is_ptd AND volume IS NOT NULL""",
        "growth_penetration": per_world("""SELECT site_id, year, trimester, is_ptd, volume_growth,
            premium_growth, penetration FROM {w}_kpis"""),
        "points_total": per_world("""SELECT site_id, year, trimester, is_ptd, penetration_points,
            volume_points, premium_points, service_points, facility_points, total FROM {w}_scored"""),
        "region_rank": per_world("""SELECT site_id, region, owner_name, year, trimester, is_ptd, total,
            CAST(rank AS BIGINT) AS rank FROM {w}_ranked"""),
        "owner_region_avg": per_world(f"""SELECT region, owner_name, wave_id,
            {rnd('owner_avg')} AS owner_avg, {rnd('region_avg')} AS region_avg FROM {{w}}_owner_avg"""),
        "score_average_sheet": per_world(f"""
            SELECT region, owner_name, wave_id AS period, owner_name AS label, {rnd('owner_avg')} AS value
            FROM {{w}}_owner_avg
            UNION ALL
            SELECT region, owner_name, wave_id, region || {q(' Region Average')}, {rnd('region_avg')}
            FROM {{w}}_owner_avg"""),
        "scored_wide": _scored_wide(),
        "member_vs_other": per_world("SELECT region, wave_id, " + ", ".join(
            f"{rnd(c)} AS {c}" for c in _MVO) + " FROM {w}_mvo"),
        "owner_vs_region_survey": per_world(
            "SELECT o.owner_name, o.region, o.wave_id, "
            + ", ".join(f"{rnd('o.' + c)} AS {c}" for c in ("service", "facility", "experience")) + ", "
            + ", ".join(f"{rnd('m.' + c)} AS {c}" for c in _MVO)
            + " FROM {w}_owner_survey o LEFT JOIN {w}_mvo m ON m.region = o.region AND m.wave_id = o.wave_id"),
        "distinct_pairs": cw + "SELECT DISTINCT region, owner_name FROM customer_sites",
        "hierarchy_enrich": cw + """SELECT site_id, region, district, owner_name, owner_number, address, city
            FROM customer_sites""",
        "title_case_names": f"SELECT p_partkey, p_name, {title('p_name')} AS title_name FROM part",
        "title_region": cw + f"""SELECT h.site_id, r.region AS raw_region, {title('r.region')} AS region
            FROM customer_hier h JOIN customer_roster_raw r ON r.site_id = h.site_id""",
    }
    out["prices_csv_job"] = out["prices_dedupe_first"]
    sw = with_worlds("supplier")
    out["scored_store"] = sw + """SELECT site_id, year, trimester, is_ptd, penetration_points, volume_points,
        premium_points, service_points, facility_points, total FROM supplier_scored"""
    out["report_rows"] = sw + """SELECT site_id, coalesce(region, '__unassigned__') AS region,
        coalesce(owner_name, '__unassigned__') AS owner_name, total, rank,
        count(*) OVER (PARTITION BY region, owner_name) AS report_rows FROM supplier_ranked"""
    price, kind = "format('{:.2f}', l_extendedprice)", "((l_orderkey * 8 + l_linenumber) % 97)"
    first = f"CASE {kind} WHEN 5 THEN 'sold out' WHEN 6 THEN '-' || {price} ELSE {price} END"
    out["rejected_rows"] = f"""SELECT CASE WHEN kind > 3 THEN product END AS product, CASE WHEN kind > 2 THEN price END AS price,
            CASE WHEN kind > 2 THEN day END AS date, CASE WHEN kind = 2 THEN product || ',' || price || ',' || day END AS raw_line,
            CASE kind WHEN 2 THEN 'broken record' WHEN 3 THEN 'no product' WHEN 4 THEN 'unreadable date'
                WHEN 5 THEN 'unreadable price: {VENDORS[0]}' ELSE 'negative price: {VENDORS[0]}' END AS reasons
        FROM (SELECT CAST(l_partkey AS VARCHAR) AS product, {first} AS price, {kind} AS kind,
                     CASE {kind} WHEN 4 THEN strftime(l_shipdate, '%Y-%m') ELSE strftime(l_shipdate, '%m/%d/%Y') END AS day
              FROM lineitem) x
        WHERE kind BETWEEN 2 AND 6"""
    out["crosstab_open"] = cw[:-1] + """, cells AS (SELECT territory_manager, coalesce('n_' || q7, 'missing') AS name FROM customer_survey)
        SELECT * EXCLUDE (tm), CAST(0 AS BIGINT) AS other FROM (PIVOT cells ON name USING count(*) GROUP BY territory_manager)
        JOIN (SELECT territory_manager AS tm, count(*) AS total FROM customer_survey GROUP BY 1)
          ON tm IS NOT DISTINCT FROM territory_manager"""
    out["log_sizes"] = """SELECT 'log' AS step, count(*) AS row_count FROM lineitem
        UNION ALL SELECT 'final', count(DISTINCT (l_partkey, CAST(l_shipdate AS DATE))) FROM lineitem"""
    # the same results, reached part by part and from file footers
    out["volume_by_layout"] = out["volume_semi_sum"]
    out["period_incremental"], out["latest_month_footers"] = out["period_open"], out["latest_month"]
    return out


_MVO = [f"{m}_{g}" for m in ("service", "facility", "experience") for g in ("member", "non_member")]

SQL: dict[str, str] = _sql_queries()
