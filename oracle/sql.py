"""DuckDB oracles: every result as SQL over the raw tables.

Written apart from the Spark plans: decimals where Spark sums integer units,
moment formulas and range self-joins where Spark uses windows, self-joins where
Spark uses lag and lead, direct text functions where Spark reads sheet cells.
"""

from __future__ import annotations

FIRST_YEAR, LAST_YEAR = (f"(SELECT {f}(year(CAST(l_shipdate AS DATE))) FROM lineitem)" for f in ("MIN", "MAX"))
_FIRST_FRIDAY = "(SELECT CAST(date_trunc('week', MIN(l_shipdate)) AS DATE) + 4 FROM lineitem)"
_LAST_MONTH = "(SELECT CAST(date_trunc('month', MAX(o_orderdate)) AS DATE) FROM orders)"
WINDOW, MIN_YEARS, RATE_YEARS = 5, 5, 7

_SECTORS = (
    "['Energy','Materials','Industrials','Consumer Discretionary','Consumer Staples','Health Care',"
    "'Financials','Information Technology','Communication Services','Utilities','Real Estate']"
)
_COUNTRIES = "['US','GB','DE','JP','CN']"
_CURRENCIES = "['USD','GBP','EUR','JPY','CNY']"
_NAMES = "['United States','United Kingdom','Germany','Japan','China']"
_MEASURES = ["revenue", "ebitda", "interest_expense", "free_cash_flow", "gross_profit", "total_debt", "cost_of_goods_sold"]


def rnd(expr: str, digits: int) -> str:
    """Half-away-from-zero rounding on the shortest decimal text of a double."""
    return f"CAST(ROUND(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _statements(bucket: str, end: str, kind: str) -> str:
    return f"""
SELECT l_suppkey AS company_id, {end} AS period_end_date, '{kind}' AS period_type,
  CAST(SUM(p*(1-d)) AS DOUBLE) AS revenue,
  CAST(SUM(p*(CAST(0.11 AS DECIMAL(5,2))-d)) AS DOUBLE) AS ebitda,
  CASE WHEN l_suppkey % 17 <> 0 THEN CAST(SUM(p*t) AS DOUBLE) END AS interest_expense,
  CAST(SUM(CASE WHEN l_linestatus='F' THEN p*(1-d) ELSE -10*p*d END) AS DOUBLE) AS free_cash_flow,
  CAST(SUM(p*(1-d)) - SUM(p*(CAST(0.6 AS DECIMAL(5,2))+d)) AS DOUBLE) AS gross_profit,
  CAST(SUM(CASE WHEN l_returnflag='R' THEN p END) AS DOUBLE) AS total_debt,
  CAST(SUM(p*(CAST(0.6 AS DECIMAL(5,2))+d)) AS DOUBLE) AS cost_of_goods_sold
FROM li GROUP BY l_suppkey, {bucket}"""


_CTES: dict[str, tuple[list[str], str]] = {
    "li": ([], """
SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_extendedprice AS DECIMAL(15,2)) AS p, CAST(l_discount AS DECIMAL(5,2)) AS d,
  CAST(l_tax AS DECIMAL(5,2)) AS t, l_quantity AS q, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS day,
  CAST(date_trunc('week', l_shipdate) AS DATE) + 4 AS friday
FROM lineitem"""),
    "companies": ([], f"""
SELECT company_id, 'S' || company_id || ' ' || country_id || ' Equity' AS ticker, company_name, country_id, currency, sector AS gics_sector_name,
  sector || ' ' || list_extract(['Equipment','Services'], company_id%2+1) AS gics_industry_group_name,
  sector || ' ' || list_extract(['Equipment','Services'], company_id%2+1) || ' ' || list_extract(['North','South','West'], company_id%3+1) AS gics_industry_name,
  sector || ' ' || list_extract(['Equipment','Services'], company_id%2+1) || ' ' || list_extract(['North','South','West'], company_id%3+1)
    || ' ' || list_extract(['Large','Small'], company_id%5%2+1) AS gics_sub_industry_name,
  cap, TRUE AS is_active
FROM (SELECT s_suppkey AS company_id, s_name AS company_name, CAST(s_acctbal AS DECIMAL(20,2)) AS cap,
        list_extract({_COUNTRIES}, n_regionkey+1) AS country_id, list_extract({_CURRENCIES}, n_regionkey+1) AS currency,
        CASE WHEN s_nationkey <> 24 THEN list_extract({_SECTORS}, s_nationkey%11+1) END AS sector
      FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""),
    "countries": ([], f"SELECT unnest({_COUNTRIES}) AS country_id, unnest({_NAMES}) AS country_name, unnest({_CURRENCIES}) AS currency"),
    "annual": (["li"], _statements("year(day)", "make_date(year(ANY_VALUE(day)),12,31)", "ANNUAL")),
    "quarterly": (["li"], _statements("year(day), quarter(day)", "last_day(CAST(date_trunc('quarter', ANY_VALUE(day)) AS DATE) + INTERVAL 2 MONTH)", "QUARTERLY")),
    "financials": (["annual", "quarterly"], "SELECT * FROM annual UNION ALL SELECT * FROM quarterly"),
    "weekly": (["li"], "SELECT l_suppkey AS company_id, friday AS price_date, CAST(SUM(p) AS DOUBLE) AS value, SUM(q) AS quantity, COUNT(*) AS lines FROM li GROUP BY 1, 2"),
    "prices": (["weekly"], """
SELECT company_id, price_date, close_price, (close_price - prev)/prev*100 AS total_return
FROM (SELECT *, LAG(close_price) OVER (PARTITION BY company_id ORDER BY price_date) AS prev
      FROM (SELECT company_id, price_date, value/quantity AS close_price FROM weekly))"""),
    "sales": (["li"], "SELECT l_suppkey AS company_id, year(day) AS year, SUM(p*(1-d)) AS revenue, SUM(p) AS value, SUM(q) AS quantity FROM li GROUP BY 1, 2"),
    "membership": (["sales", "companies"], """
SELECT 'UKX' AS index_id, company_id, make_date(year,12,31) AS as_of_date,
  CAST(ROUND(CAST(revenue AS DOUBLE)/CAST(total AS DOUBLE)*100, 6) AS DECIMAL(10,6)) AS weight,
  quantity AS shares_outstanding, price
FROM (SELECT *, SUM(revenue) OVER (PARTITION BY year) AS total, ROUND(CAST(value AS DOUBLE)/quantity, 4) AS price
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY year ORDER BY revenue DESC, company_id) AS r FROM sales) WHERE r <= 30)
UNION ALL
SELECT 'SPX', company_id, make_date(year,12,31), NULL, NULL, ROUND(CAST(value AS DOUBLE)/quantity, 4)
FROM (SELECT s.*, ROW_NUMBER() OVER (PARTITION BY year ORDER BY revenue DESC, company_id) AS r
      FROM sales s JOIN companies USING (company_id) WHERE country_id = 'US') WHERE r <= 15"""),
    "ukx": (["membership"], "SELECT *, year(as_of_date) AS year FROM membership WHERE index_id = 'UKX'"),
    "monthly": ([], f"""
SELECT list_extract({_COUNTRIES}, n_regionkey+1) AS country_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS v, COUNT(*) AS n,
  SUM(CASE WHEN o_orderpriority='1-URGENT' THEN 1 ELSE 0 END) AS urgent, SUM(CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END) AS filled
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2"""),
    "macro": (["monthly"], """
SELECT country_id, m AS indicator_date, name AS indicator_name, country_id || code || ' Index' AS bloomberg_ticker, x AS indicator_value, category AS indicator_category
FROM (
  SELECT country_id, m, 'Real GDP (YoY %)' AS name, 'GDPYOY' AS code, (v-lv)/lv*100 AS x, 'GDP' AS category FROM lagged
  UNION ALL SELECT country_id, m, 'Nominal GDP (USD bn)', 'GDPNOM', v/1000000.0, 'GDP' FROM lagged
  UNION ALL SELECT country_id, m, 'CPI (YoY %)', 'CPIYOY', (v/n-lm)/lm*100, 'CPI' FROM lagged
  UNION ALL SELECT country_id, m, 'CPI Index Level', 'CPIIDX', v/n, 'CPI' FROM lagged
  UNION ALL SELECT country_id, m, 'Housing Starts (Units)', 'HOUSST', CAST(urgent AS DOUBLE), 'Housing' FROM lagged
  UNION ALL SELECT country_id, m, 'Employment Share (%)', 'EMPSHR', filled*100.0/n, 'Employment' FROM lagged)
WHERE x IS NOT NULL"""),
    "lagged": (["monthly"], """
SELECT *, LAG(v, 12) OVER (PARTITION BY country_id ORDER BY m) AS lv, LAG(v/n, 12) OVER (PARTITION BY country_id ORDER BY m) AS lm FROM monthly"""),
    "weekrates": (["li", "companies"], """
SELECT country_id, friday AS rate_date, SUM(t)*100 AS tax, SUM(d)*100 AS disc, COUNT(*) AS n
FROM li JOIN companies ON l_suppkey = company_id GROUP BY 1, 2"""),
    "rates": (["weekrates"], """
SELECT country_id, rate_date, '10Y_YIELD' AS rate_type, CAST(tax AS DOUBLE)/n AS rate_value FROM weekrates
UNION ALL SELECT country_id, rate_date, 'POLICY_RATE', CAST(disc AS DOUBLE)/n FROM weekrates"""),
    "gdp": (["macro"], "SELECT country_id, year(indicator_date) AS year, AVG(indicator_value) AS gdp_growth FROM macro WHERE indicator_name ILIKE '%Real GDP%yoy%' GROUP BY 1, 2"),
    "phase": (["gdp"], "SELECT *, CASE WHEN gdp_growth < 0 THEN 'Contraction' ELSE 'Expansion' END AS gdp_phase FROM gdp"),
    "trend": (["gdp"], "SELECT a.country_id, a.year, a.gdp_growth, a.gdp_growth - (SELECT b.gdp_growth FROM gdp b WHERE b.country_id=a.country_id AND b.year=(SELECT MAX(c.year) FROM gdp c WHERE c.country_id=a.country_id AND c.year<a.year)) AS gdp_change FROM gdp a"),
    "firms": (["annual", "companies"], "SELECT a.*, year(period_end_date) AS year, company_name, country_id, gics_sector_name FROM annual a JOIN companies USING (company_id) WHERE gics_sector_name <> 'Financials'"),
    "debtratio": (["firms"], "SELECT *, total_debt/revenue AS debt_ratio FROM firms WHERE total_debt IS NOT NULL AND revenue > 0"),
    "cover": (["firms"], "SELECT *, ebitda/interest_expense AS icr FROM firms WHERE ebitda IS NOT NULL AND interest_expense > 0"),
    "policy": (["rates"], "SELECT country_id, year(rate_date) AS year, AVG(rate_value) AS policy_rate FROM rates WHERE rate_type='POLICY_RATE' GROUP BY 1, 2"),
    "coverrate": (["cover", "policy"], "SELECT c.*, policy_rate FROM cover c JOIN policy p ON c.country_id=p.country_id AND c.year=p.year"),
    "rollcorr": (["coverrate"], f"""
SELECT a.company_id, a.year, COUNT(*) AS n, AVG(b.icr) AS mean_icr,
  CASE WHEN AVG(b.icr*b.icr)-AVG(b.icr)*AVG(b.icr) > 1e-14 AND AVG(b.policy_rate*b.policy_rate)-AVG(b.policy_rate)*AVG(b.policy_rate) > 1e-14
  THEN (AVG(b.icr*b.policy_rate)-AVG(b.icr)*AVG(b.policy_rate))
    / (SQRT(AVG(b.icr*b.icr)-AVG(b.icr)*AVG(b.icr))*SQRT(AVG(b.policy_rate*b.policy_rate)-AVG(b.policy_rate)*AVG(b.policy_rate))) END AS corr
FROM coverrate a JOIN coverrate b ON a.company_id=b.company_id AND b.year BETWEEN a.year-{WINDOW - 1} AND a.year
GROUP BY 1, 2 HAVING COUNT(*) = {WINDOW}"""),
    "growth": (["annual", "companies"], """
SELECT a.*, year(period_end_date) AS year, company_name, country_id, gics_sector_name, (revenue-prev)/NULLIF(prev,0)*100 AS growth
FROM (SELECT *, LAG(revenue) OVER (PARTITION BY company_id ORDER BY period_end_date) AS prev FROM annual WHERE revenue IS NOT NULL) a JOIN companies USING (company_id)"""),
    "rollvol": (["growth"], f"""
SELECT a.company_id, a.year, AVG(b.growth) AS mean_growth, SQRT(GREATEST(AVG(b.growth*b.growth)-AVG(b.growth)*AVG(b.growth),0)) AS vol
FROM growth a JOIN growth b ON a.company_id=b.company_id AND b.year BETWEEN a.year-{WINDOW - 1} AND a.year AND b.growth IS NOT NULL
WHERE a.growth IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) = {WINDOW}"""),
    "quartiles": (["rollvol", "growth"], f"""
SELECT *, NTILE(4) OVER (ORDER BY vol, company_id) AS quartile FROM (
  SELECT v.company_id, v.vol, v.mean_growth, c.gics_sector_name FROM rollvol v
  JOIN (SELECT company_id, MAX(year) AS y FROM rollvol GROUP BY 1) l ON v.company_id=l.company_id AND v.year=l.y
  JOIN (SELECT company_id, ANY_VALUE(gics_sector_name) AS gics_sector_name FROM growth GROUP BY 1 HAVING COUNT(DISTINCT year) >= {MIN_YEARS}) c ON v.company_id=c.company_id)"""),
    "qgrowth": (["quarterly", "companies"], """
SELECT a.*, country_id, gics_sector_name, company_name, CAST(date_trunc('quarter', period_end_date) AS DATE) AS qs, (revenue-prev)/NULLIF(prev,0)*100 AS growth
FROM (SELECT *, LAG(revenue) OVER (PARTITION BY company_id ORDER BY period_end_date) AS prev FROM quarterly WHERE revenue IS NOT NULL) a JOIN companies USING (company_id)"""),
    "housing": (["macro"], "SELECT country_id, CAST(date_trunc('quarter', indicator_date) AS DATE) AS qs, AVG(indicator_value) AS starts FROM macro WHERE indicator_name ILIKE '%housing start%' GROUP BY 1, 2"),
    "cpi": (["macro"], "SELECT CAST(date_trunc('month', indicator_date) AS DATE) AS m, AVG(indicator_value) AS cpi_yoy FROM macro WHERE indicator_name ILIKE '%CPI%yoy%' AND country_id='US' GROUP BY 1"),
    "cpichg": (["cpi"], "SELECT m, cpi_yoy - LAG(cpi_yoy) OVER (ORDER BY m) AS cpi_change FROM cpi"),
    "sectormonth": (["prices", "companies"], "SELECT CAST(date_trunc('month', price_date) AS DATE) AS m, gics_sector_name, AVG(total_return) AS r FROM prices JOIN companies USING (company_id) WHERE country_id='US' GROUP BY 1, 2"),
    "sectorweek": (["prices", "companies"], "SELECT price_date, gics_sector_name, AVG(total_return) AS r FROM prices JOIN companies USING (company_id) WHERE country_id='US' AND gics_sector_name IS NOT NULL GROUP BY 1, 2"),
    "yieldchg": (["rates"], "SELECT rate_date, rate_value - LAG(rate_value) OVER (ORDER BY rate_date) AS chg FROM rates WHERE country_id='US' AND rate_type='10Y_YIELD'"),
    "sectoryield": (["sectorweek", "yieldchg"], "SELECT price_date, gics_sector_name, r, chg FROM sectorweek JOIN yieldchg ON price_date=rate_date WHERE chg IS NOT NULL"),
    "sectorcpi": (["sectormonth", "cpichg"], "SELECT s.m, gics_sector_name, r*4.33 AS ret, cpi_change FROM sectormonth s JOIN cpichg c ON s.m=c.m WHERE gics_sector_name IS NOT NULL"),
    "changes": (["ukx"], f"""
SELECT a.company_id, a.year, 'ENTRY' AS status FROM ukx a LEFT JOIN ukx b ON a.company_id=b.company_id AND a.year=b.year+1 WHERE b.company_id IS NULL
UNION ALL SELECT a.company_id, a.year, 'EXIT' FROM ukx a LEFT JOIN ukx b ON a.company_id=b.company_id AND a.year=b.year-1 WHERE b.company_id IS NULL AND a.year < {LAST_YEAR}"""),
    "decline": (["firms"], """
SELECT f.*, CASE WHEN total_debt < p1 AND p1 < p2 THEN 1 ELSE 0 END AS falling
FROM (SELECT *, LAG(total_debt,1) OVER w AS p1, LAG(total_debt,2) OVER w AS p2 FROM firms WHERE total_debt IS NOT NULL WINDOW w AS (PARTITION BY company_id ORDER BY period_end_date)) f
WHERE p2 IS NOT NULL"""),
    "streaks": (["cover"], """
SELECT *, flag + COALESCE(LAG(flag,1) OVER w,0) + COALESCE(LAG(flag,2) OVER w,0) AS streak
FROM (SELECT *, CASE WHEN icr < 1.5 THEN 1 ELSE 0 END AS flag FROM cover) WINDOW w AS (PARTITION BY company_id ORDER BY year)"""),
    "shock": (["cover"], f"SELECT *, ebitda/(interest_expense + total_debt*0.5*CAST(0.02 AS DOUBLE)) AS shocked FROM cover WHERE year={LAST_YEAR} AND total_debt IS NOT NULL"),
    "faulty_firms": (["companies"], """
SELECT company_id, CASE WHEN company_id % 40 <> 3 THEN ticker END AS ticker, country_id, gics_sector_name, gics_industry_group_name, gics_industry_name, gics_sub_industry_name
FROM companies WHERE company_id % 10 <> 0 UNION ALL
SELECT company_id, CASE WHEN company_id % 40 <> 3 THEN ticker END, country_id, gics_sector_name, gics_industry_group_name, gics_industry_name, gics_sub_industry_name
FROM companies WHERE company_id % 25 = 1"""),
    "faulty_members": (["membership"], "SELECT * FROM membership UNION ALL SELECT * FROM membership WHERE index_id = 'SPX'"),
    "faulty_macro": (["macro"], """
SELECT country_id, indicator_date, bloomberg_ticker, CASE WHEN NOT (country_id = 'JP' AND bloomberg_ticker LIKE '%GDPNOM Index') THEN indicator_name END AS indicator_name FROM macro"""),
    "faulty_rates": (["rates"], "SELECT CASE WHEN country_id = 'CN' THEN 'XX' ELSE country_id END AS country_id, rate_date, rate_type FROM rates"),
    "ordertext": ([], """
SELECT o_orderkey, o_totalprice,
  CASE o_orderpriority WHEN '5-LOW' THEN '#N/A' WHEN '4-NOT SPECIFIED' THEN '--' WHEN '2-HIGH' THEN 'pending' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS number_text,
  CASE WHEN o_orderstatus='P' THEN 'on ' ELSE '' END || CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate,'%Y-%m-%d') WHEN '2-HIGH' THEN strftime(o_orderdate,'%m/%d/%Y')
     WHEN '3-MEDIUM' THEN strftime(o_orderdate,'%d/%m/%Y') WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate,'%d-%m-%Y') ELSE strftime(o_orderdate,'%Y/%-m/%-d') END AS date_text,
  CASE WHEN o_orderpriority IN ('5-LOW','4-NOT SPECIFIED','1-URGENT','2-HIGH') THEN NULL ELSE o_orderpriority END AS label
FROM orders"""),
    "orderparsed": (["ordertext"], """
SELECT o_orderkey, TRY_CAST(number_text AS DOUBLE) AS number, number_text IN ('#N/A','--') AS missing,
  CAST(COALESCE(try_strptime(date_text,'%Y-%m-%d'), try_strptime(date_text,'%m/%d/%Y'), try_strptime(date_text,'%d/%m/%Y'),
    try_strptime(date_text,'%Y/%m/%d'), try_strptime(date_text,'%d-%m-%Y'), try_strptime(date_text,'%m-%d-%Y')) AS DATE) AS parsed_date
FROM ordertext"""),
}


def _closure(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _closure(_CTES[name][0], seen)
            seen.append(name)
    return seen


_CTES["macro"][0].append("lagged")


def sql(needs: str, body: str) -> str:
    used = _closure(needs.split(), [])
    if not used:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1].strip()})" for n in used) + "\n" + body.strip()


_MARKETS = "(VALUES ('SPX', 'US'), ('UKX', 'GB')) i(index_id, country_id)"
# (reference, child, column, parent, parent column)
_DECLARED = [
    ("indices.country_id -> countries.country_id", _MARKETS, "country_id", "countries", "country_id"),
    ("companies.country_id -> countries.country_id", "faulty_firms", "country_id", "countries", "country_id"),
    ("index_membership.index_id -> indices.index_id", "faulty_members", "index_id", _MARKETS, "index_id"),
    ("index_membership.company_id -> companies.company_id", "faulty_members", "company_id", "faulty_firms", "company_id"),
    ("prices_weekly.company_id -> companies.company_id", "prices", "company_id", "faulty_firms", "company_id"),
    ("financials.company_id -> companies.company_id", "financials", "company_id", "faulty_firms", "company_id"),
    ("macro_indicators.country_id -> countries.country_id", "faulty_macro", "country_id", "countries", "country_id"),
    ("interest_rates.country_id -> countries.country_id", "faulty_rates", "country_id", "countries", "country_id"),
]


def _declared_rules() -> str:
    sectors = "(SELECT DISTINCT gics_sector_name, gics_industry_group_name, gics_industry_name, gics_sub_industry_name FROM companies WHERE gics_sector_name IS NOT NULL)"
    tables = [  # table, source, key, further unique column, required columns
        ("countries", "countries", "country_id", None, []), ("indices", _MARKETS, "index_id", None, []), ("gics_sectors", sectors, None, None, []),
        ("companies", "faulty_firms", "company_id", "ticker", ["ticker"]),
        ("index_membership", "faulty_members", "index_id, company_id, as_of_date", None, ["index_id", "company_id", "as_of_date"]),
        ("prices_weekly", "prices", "company_id, price_date", None, ["company_id", "price_date"]),
        ("financials", "financials", "company_id, period_end_date, period_type", None, ["company_id", "period_end_date", "period_type"]),
        ("macro_indicators", "faulty_macro", "country_id, indicator_date, bloomberg_ticker", None, ["country_id", "indicator_date", "indicator_name"]),
        ("interest_rates", "faulty_rates", "country_id, rate_date, rate_type", None, ["country_id", "rate_date", "rate_type"]),
    ]
    out = []
    for name, source, key, unique, required in tables:
        if key is None:
            out.append(f"SELECT '{name}' AS table_name, 'unique' AS rule, 'sector_id' AS columns, COUNT(*) AS rows, CAST(0 AS BIGINT) AS violations FROM {source}")
        for columns in [c for c in (key, unique) if c]:
            known = " AND ".join(f"{c} IS NOT NULL" for c in columns.split(", "))
            out.append(f"SELECT '{name}' AS table_name, 'unique' AS rule, '{columns}' AS columns, COUNT(*) AS rows, "
                       f"COUNT(*) FILTER ({known}) - COUNT(DISTINCT ({columns})) FILTER ({known}) AS violations FROM {source}")
        out += [f"SELECT '{name}', 'not_null', '{c}', COUNT(*), COUNT(*) FILTER ({c} IS NULL) FROM {source}" for c in required]
    return "\nUNION ALL ".join(out)


_HHI = f"""
SELECT year, {rnd('hhi', 2)} AS hhi_index, num_members, {rnd('sw/num_members', 2)} AS avg_weight_pct, {rnd('mw', 2)} AS largest_weight_pct,
  {rnd('10000.0/hhi', 1)} AS effective_positions,
  CASE WHEN hhi < 1500 THEN 'Unconcentrated' WHEN hhi < 2500 THEN 'Moderately Concentrated' ELSE 'Highly Concentrated' END AS concentration_level
FROM (SELECT year, CAST(SUM(weight*weight) AS DOUBLE) AS hhi, COUNT(*) AS num_members, CAST(SUM(weight) AS DOUBLE) AS sw, CAST(MAX(weight) AS DOUBLE) AS mw
      FROM ukx WHERE weight IS NOT NULL GROUP BY year)"""
_CHURN = """
SELECT y.year, COUNT(*) FILTER (c.status='ENTRY') AS entries, COUNT(*) FILTER (c.status='EXIT') AS exits
FROM (SELECT DISTINCT year FROM ukx) y LEFT JOIN changes c ON c.year=y.year GROUP BY 1"""
_ROLLING = f"SELECT company_id, year, {rnd('mean_growth', 6)} AS mean_growth, {rnd('vol', 6)} AS volatility FROM rollvol"
_ASOF = """
SELECT p.company_id, p.price_date, f.available_date AS asof_available_date, f.period_type, f.period_end_date, f.revenue
FROM prices p ASOF LEFT JOIN (SELECT *, period_end_date + CASE WHEN period_type='ANNUAL' THEN 75 ELSE 45 END AS available_date FROM financials) f
ON p.company_id=f.company_id AND p.price_date >= f.available_date"""
_SENSITIVE = f"""
SELECT company_name, gics_sector_name, country_id, years AS total_years_data, {rnd('mean_icr', 2)} AS avg_icr_recent_5y, {rnd('corr', 4)} AS correlation_with_policy_rate,
  CASE WHEN corr < -0.3 THEN 'Highly Rate-Sensitive' WHEN corr < 0 THEN 'Moderately Rate-Sensitive' WHEN corr < 0.3 THEN 'Rate-Insulated' ELSE 'Positively Correlated' END AS rate_sensitivity_classification
FROM rollcorr r JOIN (SELECT company_id, MAX(year) AS y FROM rollcorr GROUP BY 1) l ON r.company_id=l.company_id AND r.year=l.y
JOIN (SELECT company_id, ANY_VALUE(company_name) AS company_name, ANY_VALUE(gics_sector_name) AS gics_sector_name, ANY_VALUE(country_id) AS country_id, COUNT(DISTINCT year) AS years FROM coverrate GROUP BY 1) c ON r.company_id=c.company_id
WHERE years >= {RATE_YEARS} AND corr IS NOT NULL ORDER BY corr, r.company_id"""
_GEO = f"""
SELECT c.country_id, total_companies, zombie_count, {rnd('zombie_count*100.0/total_companies', 1)} AS zombie_pct, {rnd('debt/1000000', 2)} AS zombie_debt_bn,
  {rnd('gdp', 0)} AS country_gdp_bn, {rnd('debt/1000000/NULLIF(gdp,0)*100', 2)} AS zombie_debt_pct_gdp
FROM (SELECT country_id, COUNT(*) AS total_companies, SUM(CASE WHEN icr < 1.5 THEN 1 ELSE 0 END)::BIGINT AS zombie_count, SUM(CASE WHEN icr < 1.5 THEN total_debt ELSE 0 END) AS debt FROM cover WHERE year={LAST_YEAR} GROUP BY 1) c
LEFT JOIN (SELECT country_id, AVG(indicator_value) AS gdp FROM macro WHERE indicator_name ILIKE '%Nominal GDP%bn%' AND year(indicator_date)={LAST_YEAR} GROUP BY 1) g ON c.country_id=g.country_id"""
_TOP10 = "SELECT *, ROW_NUMBER() OVER (PARTITION BY year ORDER BY weight DESC, company_id) AS rank FROM ukx WHERE weight IS NOT NULL"
_RETURNS = "SELECT year(price_date) AS year, AVG(total_return) AS r FROM prices p JOIN ukx m ON p.company_id=m.company_id AND year(p.price_date)=m.year GROUP BY 1"


def _merged(first: str, other: str) -> str:
    """Weekly units and lines of two deliveries; of a key in both the row of the first one named counts."""
    group = "SELECT l_suppkey AS company_id, friday AS price_date, CAST(SUM(q) AS BIGINT) AS quantity, COUNT(*) AS lines FROM li WHERE {} GROUP BY 1, 2"
    return sql("li", f"""SELECT * FROM (
  SELECT * FROM ({group.format('l_linenumber <= 4' if first == 'a' else 'l_linenumber >= 3')})
  UNION ALL SELECT * FROM ({group.format('l_linenumber <= 4' if other == 'a' else 'l_linenumber >= 3')}) o
  WHERE NOT EXISTS (SELECT 1 FROM li WHERE l_suppkey = o.company_id AND friday = o.price_date AND {'l_linenumber <= 4' if first == 'a' else 'l_linenumber >= 3'}))""")


def _lines_kept(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS r FROM lineitem) WHERE r = 1"""


def _leverage(label: bool) -> str:
    period = ", CASE WHEN year IN (1998,2001) THEN 'Crisis Year' WHEN year IN (1996,1997) THEN 'Boom Year' ELSE 'Normal' END AS economic_period" if label else ""
    return f"""SELECT year, COUNT(*) AS company_count, {rnd('AVG(debt_ratio)', 3)} AS mean_debt_to_revenue,
  {rnd('MIN(debt_ratio)', 3)} AS min_ratio, {rnd('MAX(debt_ratio)', 3)} AS max_ratio{period} FROM debtratio GROUP BY year"""


def _quartiles(sectors: bool) -> str:
    extra = "string_agg(DISTINCT gics_sector_name, ',' ORDER BY gics_sector_name) AS sectors_represented," if sectors else ""
    return f"""SELECT quartile AS volatility_quartile, CASE quartile WHEN 1 THEN 'Low Volatility (Defensive)' WHEN 2 THEN 'Below Average'
  WHEN 3 THEN 'Above Average' WHEN 4 THEN 'High Volatility (Cyclical)' END AS classification, COUNT(*) AS company_count, {extra}
  {rnd('AVG(vol)', 2)} AS avg_volatility, {rnd('AVG(mean_growth)', 2)} AS avg_growth_rate FROM quartiles GROUP BY quartile"""


def _resilience(source: str, gdp: str, key: str, label: str) -> str:
    return f"""SELECT g.country_id, {label}, {rnd('g.x', 2)} AS gdp_growth_pct, COUNT(*) AS total_companies,
  CAST(SUM(CASE WHEN growth < 0 AND free_cash_flow > 0 THEN 1 ELSE 0 END) AS BIGINT) AS resilient_companies,
  {rnd('SUM(CASE WHEN growth < 0 AND free_cash_flow > 0 THEN 1 ELSE 0 END)*100.0/COUNT(*)', 1)} AS resilience_rate_pct
FROM {source} s JOIN ({gdp}) g ON s.country_id=g.country_id AND s.{key}=g.{key}
WHERE growth IS NOT NULL AND gics_sector_name <> 'Financials' GROUP BY g.country_id, g.{key}, g.x"""


def _housing(source: str, starts: str, key: str) -> str:
    return f"""SELECT gics_sector_name, s.country_id, COUNT(*) AS observations, {rnd('AVG(growth)', 2)} AS avg_revenue_growth_pct, {rnd('AVG(lag2)', 2)} AS avg_housing_lag_2q
FROM {source} s JOIN (SELECT *, LAG(starts, 2) OVER (PARTITION BY country_id ORDER BY {key}) AS lag2 FROM ({starts})) h ON s.country_id=h.country_id AND s.{key}=h.{key}
WHERE growth IS NOT NULL AND lag2 IS NOT NULL AND gics_sector_name IN ('Consumer Discretionary','Materials','Industrials') GROUP BY 1, 2"""


_POP_CORR = "CASE WHEN VAR_POP({x}) > 0 AND VAR_POP({y}) > 0 THEN (AVG({x}*{y})-AVG({x})*AVG({y}))/(SQRT(AVG({x}*{x})-AVG({x})*AVG({x}))*SQRT(AVG({y}*{y})-AVG({y})*AVG({y}))) END"

ORACLES: dict[str, str] = {
    # ingest
    "ingest_snapshot_union": sql("membership companies", """
SELECT index_id, as_of_date, ticker, company_name AS name, CAST(weight AS DOUBLE) AS weight, CAST(price AS DOUBLE) AS price FROM membership JOIN companies USING (company_id)"""),
    "ingest_wide_pairs": sql("weekly", """
SELECT company_id, price_date, value AS close_price, CASE WHEN (company_id + date_diff('day', DATE '1970-01-02', price_date)) % 5 <> 0 THEN quantity END AS total_return
FROM weekly WHERE (company_id + date_diff('day', DATE '1970-01-02', price_date)) % 11 <> 0"""),
    "ingest_wide_fields": sql("annual", f"SELECT company_id, period_end_date, period_type, {', '.join(_MEASURES)} FROM annual"),
    "ingest_month_columns": sql("macro", f"""
SELECT country_id, indicator_date, indicator_name, bloomberg_ticker, indicator_category,
  CASE WHEN indicator_name ILIKE 'Nominal%' THEN {rnd('indicator_value * 1000000', 2)} WHEN indicator_name ILIKE 'Housing%' THEN indicator_value ELSE {rnd('indicator_value', 6)} END AS indicator_value
FROM macro"""),
    "ingest_text_cells": sql("weekrates", f"""
SELECT DISTINCT date_diff('day', {_FIRST_FRIDAY}, rate_date) // 7 + 6 AS row_no, 0 AS col_no, CAST(rate_date AS VARCHAR) AS value FROM weekrates
UNION ALL SELECT date_diff('day', {_FIRST_FRIDAY}, rate_date) // 7 + 6, list_position(['US','GB','DE','JP','CN'], country_id) + k,
  CASE WHEN x = 0 THEN 'N/A' ELSE format('{{:,}}', CAST(x AS BIGINT)) END
FROM (SELECT rate_date, country_id, 0 AS k, tax AS x FROM weekrates UNION ALL SELECT rate_date, country_id, 5, disc FROM weekrates)"""),
    "ingest_text_companies": sql("companies", """
SELECT ticker, CASE WHEN company_id % 5 = 0 THEN company_name || chr(10) || 'formerly "' || ticker || '"' ELSE company_name END AS company_name,
  country_id, currency, gics_sector_name, gics_sub_industry_name, cap AS current_market_cap FROM companies
UNION ALL SELECT 'TICKER', 'NAME', 'CO', 'CRNCY', 'GICS_SECTOR_NAME', 'GICS_SUB_INDUSTRY_NAME', NULL"""),
    "ingest_rate_columns": sql("weekrates", """
SELECT w.country_id, rate_date, k.rate_type, k.ticker AS bloomberg_ticker, CAST(CASE WHEN k.rate_type='10Y_YIELD' THEN tax ELSE disc END AS DOUBLE) AS rate_value
FROM weekrates w JOIN (VALUES ('US','10Y_YIELD','USGG10YR Index'),('GB','10Y_YIELD','GTGBP10Y Govt'),('DE','10Y_YIELD','GTDEM10Y Govt'),('JP','10Y_YIELD','GTJPY10Y Govt'),('CN','10Y_YIELD','GTCNY10Y Govt'),
 ('US','POLICY_RATE','FDTR Index'),('GB','POLICY_RATE','UKBRBASE Index'),('DE','POLICY_RATE','EURR002W Index'),('JP','POLICY_RATE','BOJDTR Index'),('CN','POLICY_RATE','PBOC7P Index')) k(country_id, rate_type, ticker)
 ON w.country_id=k.country_id WHERE (CASE WHEN k.rate_type='10Y_YIELD' THEN tax ELSE disc END) <> 0"""),
    "calendar_fill": sql("quarterly", f"""
SELECT (year(period_end_date)-{FIRST_YEAR})*4 + quarter(period_end_date) - 1 + 6 AS row_no, period_end_date, COUNT(*)*7 AS cells FROM quarterly GROUP BY 1, 2"""),
    "dim_constants": sql("countries companies", """
SELECT c.country_id, c.country_name, c.currency, i.index_id, i.index_name, n.companies FROM countries c
LEFT JOIN (VALUES ('US','SPX','S&P 500'),('GB','UKX','FTSE 100')) i(country_id, index_id, index_name) ON c.country_id=i.country_id
LEFT JOIN (SELECT country_id, COUNT(*) AS companies FROM companies GROUP BY 1) n ON c.country_id=n.country_id"""),
    "dedup_first_wins": _lines_kept("ASC"),
    "dedup_last_wins": _lines_kept("DESC"),
    "merge_first_wins": _merged("a", "b"),
    "merge_last_wins": _merged("b", "a"),
    "assign_keys_incremental": sql("companies", """
SELECT ticker, ROW_NUMBER() OVER (ORDER BY company_id % 3 = 0, ticker) AS company_key FROM companies"""),
    "incremental_hhi": sql("ukx", _HHI),
    "incremental_churn": sql("ukx changes", _CHURN),
    "incremental_volatility": sql("rollvol", _ROLLING),
    "clean_odd_texts": """
SELECT o_orderkey, CASE k WHEN 0 THEN n WHEN 5 THEN n * 100 WHEN 6 THEN -n WHEN 7 THEN n WHEN 8 THEN n WHEN 9 THEN 0.5::DOUBLE END AS number,
  k IN (1, 2, 10, 11) AS number_rejected,
  CASE WHEN f IN (0, 1, 2, 4) THEN d WHEN f = 3 AND day(d) <= 12 THEN make_date(year(d), day(d), month(d)) WHEN f = 3 THEN d END AS parsed_date,
  f IN (5, 7) AS date_rejected
FROM (SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) AS n, o_orderkey % 12 AS k, o_orderkey % 8 AS f, CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "clean_null_tokens": sql("ordertext", "SELECT o_orderkey, label FROM ordertext"),
    "clean_numeric": sql("orderparsed", "SELECT o_orderkey, number FROM orderparsed"),
    "parse_dates_multi": sql("orderparsed", "SELECT o_orderkey, parsed_date FROM orderparsed"),
    "clean_trim": "SELECT c_custkey, c_name, c_mktsegment AS segment FROM customer",
    "derive_country_code": sql("companies countries", "SELECT company_id, c.country_id || ' ' || country_name AS country, c.country_id FROM companies c JOIN countries n ON c.country_id=n.country_id"),
    "lookup_surrogate_key": "SELECT s_name AS company_name, c_custkey, c_acctbal, s_suppkey AS company_id FROM customer JOIN supplier ON replace(c_name,'Customer','Supplier') = s_name",
    "assign_surrogate_key": sql("companies", "SELECT ticker, ROW_NUMBER() OVER (ORDER BY ticker) AS company_key FROM companies"),
    "unpivot_long": sql("annual", "\nUNION ALL ".join(f"SELECT company_id, period_end_date, '{m}' AS measure, {m} AS value FROM annual WHERE {m} IS NOT NULL" for m in _MEASURES)),
    "pivot_measures": sql("monthly lagged", f"SELECT country_id, m AS indicator_date, {rnd('urgent', 6)} AS housst, {rnd('v/1000000.0', 6)} AS gdpnom, {rnd('(v/n-lm)/lm*100', 6)} AS cpiyoy FROM lagged"),
    "drop_null_measure": sql("quarterly", "SELECT company_id, period_end_date, interest_expense FROM quarterly WHERE interest_expense IS NOT NULL"),
    "drop_all_null": sql("quarterly", """
SELECT company_id, period_end_date, interest_expense, CASE WHEN ebitda < 0 THEN ebitda END AS loss FROM quarterly WHERE NOT (interest_expense IS NULL AND COALESCE(ebitda >= 0, TRUE))"""),
    "categorise_keywords": """
SELECT doc_id, CASE WHEN contains(t,'gdp') THEN 'GDP' WHEN contains(t,'cpi') OR contains(t,'price') OR contains(t,'inflation') THEN 'CPI'
 WHEN contains(t,'employ') THEN 'Employment' WHEN contains(t,'housing') OR contains(t,'construction') THEN 'Housing' WHEN contains(t,'rate') OR contains(t,'yield') THEN 'Rates'
 WHEN contains(t,'trade') OR contains(t,'export') OR contains(t,'import') THEN 'Trade' ELSE 'Other' END AS category FROM (SELECT doc_id, lower(text) AS t FROM documents)""",
    "distinct_sorted_keys": "SELECT DISTINCT trim(p_name) AS ticker FROM part WHERE p_name IS NOT NULL",
    # quality
    "dq_unique_key": sql("financials prices", """
SELECT 'lineitem' AS table_name, COUNT(*) AS rows, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys, COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS repeated_rows, CAST(0 AS BIGINT) AS null_key_rows FROM lineitem
UNION ALL SELECT 'financials', COUNT(*), COUNT(DISTINCT (company_id, period_end_date, period_type)), COUNT(*) - COUNT(DISTINCT (company_id, period_end_date, period_type)), 0 FROM financials
UNION ALL SELECT 'prices_weekly', COUNT(*), COUNT(DISTINCT (company_id, price_date)), COUNT(*) - COUNT(DISTINCT (company_id, price_date)), 0 FROM prices"""),
    "dq_orphans": sql("ukx", """
SELECT 'orders.o_custkey' AS reference, COUNT(DISTINCT o_custkey) AS orphan_keys, COUNT(*) AS orphan_rows FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey=o_custkey)
UNION ALL SELECT 'customer.c_custkey', COUNT(DISTINCT c_custkey), COUNT(*) FROM customer WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey=c_custkey)
UNION ALL SELECT 'lineitem.l_partkey', COUNT(DISTINCT l_partkey), COUNT(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey=l_partkey)
UNION ALL SELECT 'lineitem.l_suppkey', COUNT(DISTINCT l_suppkey), COUNT(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM ukx WHERE company_id=l_suppkey)
UNION ALL SELECT 'events.user_id', COUNT(DISTINCT user_id), COUNT(*) FROM events WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey=user_id)"""),
    "dq_declared_rules": sql("faulty_firms faulty_members faulty_macro faulty_rates prices financials countries", _declared_rules()),
    "dq_declared_references": sql("faulty_firms faulty_members faulty_macro faulty_rates prices financials countries", "\nUNION ALL ".join(
        f"SELECT '{name}' AS reference, COUNT(DISTINCT {c}) AS orphan_keys, COUNT({c}) AS orphan_rows FROM {child} WHERE {c} NOT IN (SELECT {pc} FROM {parent})"
        for name, child, c, parent, pc in _DECLARED)),
    "load_rejects": sql("membership companies weekly quarterly weekrates monthly macro", f"""
SELECT 'index_membership' AS loader, 'unknown_ticker' AS reason, COUNT(*) AS rejected FROM membership WHERE company_id % 7 = 0
UNION ALL SELECT 'index_membership', 'bad_date', COUNT(*) FROM membership WHERE company_id % 13 = 0
UNION ALL SELECT loader, 'unknown_ticker', COUNT(*) FROM companies, (VALUES ('prices_weekly'), ('financials')) l(loader) WHERE company_id % 7 = 0 GROUP BY 1
UNION ALL SELECT 'prices_weekly', 'bad_number', COUNT(*) FROM (SELECT date_diff('day', {_FIRST_FRIDAY}, price_date) // 7 + 6 AS r, company_id * 2 + k AS c FROM weekly, (VALUES (1), (2)) v(k)) WHERE (r + c) % 97 = 0
UNION ALL SELECT 'prices_weekly', 'bad_date', COUNT(DISTINCT price_date) FROM weekly WHERE (date_diff('day', {_FIRST_FRIDAY}, price_date) // 7 + 6) % 50 = 0
UNION ALL SELECT 'financials', 'bad_number', COUNT(*) FROM (SELECT (year(period_end_date) - {FIRST_YEAR}) * 4 + quarter(period_end_date) - 1 + 6 AS r, company_id * 7 + k AS c FROM quarterly, (SELECT unnest(range(1, 8)) AS k)) WHERE (r + c) % 97 = 0
UNION ALL SELECT 'financials', 'bad_date', COUNT(DISTINCT period_end_date) FROM quarterly WHERE ((year(period_end_date) - {FIRST_YEAR}) * 4 + quarter(period_end_date) - 1 + 6) % 50 = 0 HAVING COUNT(*) > 0
UNION ALL SELECT 'macro_indicators', 'bad_number', COUNT(*) FROM macro WHERE (date_diff('month', indicator_date, {_LAST_MONTH}) + 2) % 17 = 0
UNION ALL SELECT 'interest_rates', 'bad_number', COUNT(*) FROM (SELECT date_diff('day', {_FIRST_FRIDAY}, rate_date) // 7 + 6 AS r, list_position(['US','GB','DE','JP','CN'], country_id) + k AS c
  FROM weekrates, (VALUES (0), (5)) v(k)) WHERE (r + c) % 97 = 0
UNION ALL SELECT 'interest_rates', 'bad_date', COUNT(DISTINCT rate_date) FROM weekrates WHERE (date_diff('day', {_FIRST_FRIDAY}, rate_date) // 7 + 6) % 50 = 0"""),
    "dq_rejects": sql("orderparsed", """
SELECT COUNT(number) AS number_text_parsed, SUM(CASE WHEN number IS NULL AND NOT missing THEN 1 ELSE 0 END)::BIGINT AS number_text_rejected,
  COUNT(parsed_date) AS date_text_parsed, SUM(CASE WHEN parsed_date IS NULL THEN 1 ELSE 0 END)::BIGINT AS date_text_rejected FROM orderparsed"""),
    "coverage_table_counts": sql("companies membership prices financials macro rates", """
SELECT 'companies' AS table_name, COUNT(*) AS records FROM companies UNION ALL SELECT 'index_membership', COUNT(*) FROM membership
UNION ALL SELECT 'prices_weekly', COUNT(*) FROM prices UNION ALL SELECT 'financials', COUNT(*) FROM financials
UNION ALL SELECT 'macro_indicators', COUNT(*) FROM macro UNION ALL SELECT 'interest_rates', COUNT(*) FROM rates"""),
    "coverage_profile": sql("prices financials macro", """
SELECT 'prices_weekly' AS scope, 'all' AS member, MIN(price_date) AS first_date, MAX(price_date) AS last_date, COUNT(DISTINCT company_id) AS entities, COUNT(*) AS records FROM prices
UNION ALL SELECT 'financials', period_type, MIN(period_end_date), MAX(period_end_date), COUNT(DISTINCT company_id), COUNT(*) FROM financials GROUP BY period_type
UNION ALL SELECT 'macro_indicators', country_id, MIN(indicator_date), MAX(indicator_date), COUNT(DISTINCT indicator_name), COUNT(*) FROM macro GROUP BY country_id"""),
    "coverage_members": sql("membership", "SELECT index_id, as_of_date, COUNT(*) AS member_count FROM membership GROUP BY 1, 2"),
    "coverage_by_year": sql("annual", "SELECT year(period_end_date) AS year, COUNT(DISTINCT company_id) AS companies FROM annual GROUP BY 1"),
    "coverage_continuity": sql("annual companies", """
SELECT ticker, company_name, COUNT(DISTINCT year(period_end_date)) AS years_of_data FROM annual JOIN companies USING (company_id)
WHERE company_name IN ('Supplier#000000001','Supplier#000000004','Supplier#000000009') GROUP BY 1, 2"""),
    "coverage_nonnull_points": sql("quarterly", f"""
SELECT year, data_points, companies, {rnd('data_points*100.0/MAX(data_points) OVER ()', 1)} AS pct_of_peak
FROM (SELECT year(period_end_date) AS year, {' + '.join(f'COUNT({m})' for m in _MEASURES)} AS data_points, COUNT(DISTINCT company_id) AS companies FROM quarterly GROUP BY 1)"""),
    # scalars
    "fn_period_buckets": """
SELECT year(o_orderdate) AS year, strftime(o_orderdate,'%Y-%m') AS year_month,
 CASE WHEN month(o_orderdate) BETWEEN 1 AND 3 THEN 'Q1' WHEN month(o_orderdate) BETWEEN 4 AND 6 THEN 'Q2' WHEN month(o_orderdate) BETWEEN 7 AND 9 THEN 'Q3' ELSE 'Q4' END AS quarter,
 year(o_orderdate) || '-' || CASE WHEN month(o_orderdate) BETWEEN 1 AND 3 THEN 'Q1' WHEN month(o_orderdate) BETWEEN 4 AND 6 THEN 'Q2' WHEN month(o_orderdate) BETWEEN 7 AND 9 THEN 'Q3' ELSE 'Q4' END AS year_quarter,
 COUNT(*) AS orders FROM orders GROUP BY 1, 2, 3, 4""",
    "ratio_guarded": sql("quarterly", f"""
SELECT company_id, period_end_date, CASE WHEN interest_expense > 0 THEN {rnd('ebitda/interest_expense', 6)} END AS icr,
  {rnd('free_cash_flow/NULLIF(total_debt,0)', 6)} AS fcf_to_debt, CASE WHEN ebitda > 0 THEN {rnd('revenue/ebitda', 6)} END AS revenue_to_ebitda FROM quarterly"""),
    "band_thresholds": sql("annual", """
SELECT CASE WHEN interest_expense > 0 AND ebitda/interest_expense < 1.4 THEN 'weak' WHEN interest_expense > 0 AND ebitda/interest_expense < 1.6 THEN 'fair' ELSE 'strong or unknown' END AS coverage_band,
  CASE WHEN total_debt/revenue*100 > 35 THEN 'high' WHEN total_debt/revenue*100 > 30 THEN 'middle' ELSE 'low' END AS debt_band, COUNT(*) AS firms FROM annual GROUP BY 1, 2"""),
    "label_periods": f"""
SELECT CASE WHEN year(o_orderdate) IN (1998,2001) THEN 'Crisis Year' WHEN year(o_orderdate) IN (1996,1997) THEN 'Boom Year' ELSE 'Normal' END AS economic_period,
  COUNT(*) AS orders, {rnd('CAST(SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE)/COUNT(*)', 4)} AS mean_value FROM orders GROUP BY 1""",
    "growth_pct": sql("annual", f"""
SELECT company_id, period_end_date, {rnd('(revenue-prev)/NULLIF(prev,0)*100', 6)} AS growth FROM (SELECT *, LAG(revenue) OVER (PARTITION BY company_id ORDER BY period_end_date) AS prev FROM annual)"""),
    "annualise_returns": sql("prices companies", f"""
SELECT country_id, year(price_date) AS year, {rnd('AVG(total_return)*4.33', 4)} AS monthly_return_pct, {rnd('AVG(total_return)*52', 4)} AS annual_return_pct FROM prices JOIN companies USING (company_id) GROUP BY 1, 2"""),
    "scenario_rate_shock": sql("shock", f"""
SELECT bp AS shock_bp, share AS floating_share, COUNT(*) AS total_companies,
  SUM(CASE WHEN icr >= 1.5 AND ebitda/(interest_expense+total_debt*share*(bp/10000)) < 1.5 THEN 1 ELSE 0 END)::BIGINT AS newly_distressed,
  {rnd('AVG(ebitda/(interest_expense+total_debt*share*(bp/10000)))', 4)} AS avg_shocked_icr
FROM shock, (SELECT unnest([100.0,200.0,300.0]::DOUBLE[]) AS bp), (SELECT unnest([0.25,0.5,1.0]::DOUBLE[]) AS share) GROUP BY 1, 2"""),
    "fn_clip": sql("annual", f"SELECT company_id, period_end_date, CASE WHEN interest_expense > 0 THEN {rnd('CASE WHEN ebitda/interest_expense > 1.5 THEN 1.5 ELSE ebitda/interest_expense END', 6)} END AS icr_clipped FROM annual"),
    # filters
    "filter_equality": sql("companies", "SELECT company_id, ticker, country_id FROM companies WHERE country_id='US'"),
    "filter_exclude_sector": sql("companies", "SELECT company_id, gics_sector_name FROM companies WHERE gics_sector_name IS NOT NULL AND gics_sector_name <> 'Financials'"),
    "filter_not_null": sql("membership", "SELECT index_id, company_id, as_of_date, CAST(weight AS DOUBLE) AS weight FROM membership WHERE weight IS NOT NULL"),
    "filter_in_list": sql("companies", "SELECT company_id, gics_sector_name FROM companies WHERE gics_sector_name IN ('Consumer Discretionary','Materials','Industrials')"),
    "filter_pattern": sql("macro", f"SELECT country_id, indicator_date, indicator_name, {rnd('indicator_value', 6)} AS indicator_value FROM macro WHERE lower(indicator_name) LIKE '%real gdp%yoy%'"),
    "filter_between": sql("annual", "SELECT company_id, year(period_end_date) AS year, revenue FROM annual WHERE year(period_end_date) BETWEEN 1997 AND 1999"),
    "topn_per_group": sql("ukx", f"SELECT year, company_id, CAST(weight AS DOUBLE) AS weight, rank FROM ({_TOP10}) WHERE rank <= 10"),
    "having_min_count": sql("companies", "SELECT country_id, gics_sector_name, COUNT(*) AS companies FROM companies GROUP BY 1, 2 HAVING COUNT(*) >= 3"),
    "membership_exits": sql("changes", "SELECT * FROM changes WHERE status='EXIT'"),
    "membership_entries": sql("changes", "SELECT * FROM changes WHERE status='ENTRY'"),
    "semi_min_history": sql("annual", f"""
SELECT company_id, period_end_date, interest_expense FROM annual WHERE interest_expense > 0 AND company_id IN (SELECT company_id FROM annual WHERE interest_expense > 0 GROUP BY 1 HAVING COUNT(*) >= {RATE_YEARS})"""),
    # joins
    "join_fact_dim": sql("annual companies", "SELECT company_id, company_name, gics_sector_name, period_end_date, revenue FROM annual JOIN companies USING (company_id)"),
    "join_left_single": sql("ukx gdp", f"""
SELECT h.year, {rnd('h.hhi', 2)} AS hhi_index, {rnd('g.gdp_growth', 6)} AS gdp_growth FROM (SELECT year, CAST(SUM(weight*weight) AS DOUBLE) AS hhi FROM ukx GROUP BY 1) h
LEFT JOIN gdp g ON h.year=g.year AND g.country_id='GB'"""),
    "join_left_composite": sql("firms phase", """
SELECT f.country_id, f.year, f.firms, p.gdp_phase FROM (SELECT country_id, year, COUNT(*) AS firms FROM firms GROUP BY 1, 2) f LEFT JOIN phase p ON f.country_id=p.country_id AND f.year=p.year"""),
    "join_period_align": sql("qgrowth housing", f"""
SELECT f.country_id, year(f.qs) || '-Q' || quarter(f.qs) AS year_quarter, f.firms, {rnd('f.revenue', 2)} AS mean_revenue, {rnd('h.starts', 6)} AS housing_starts
FROM (SELECT country_id, qs, COUNT(*) AS firms, AVG(revenue) AS revenue FROM qgrowth GROUP BY 1, 2) f JOIN housing h ON f.country_id=h.country_id AND f.qs=h.qs"""),
    "rolling_window_range": sql("rollvol", _ROLLING),
    "rolling_window_sliced": sql("rollvol", _ROLLING),
    "join_on_period_expr": sql("prices ukx", f"SELECT year, {rnd('r', 6)} AS avg_weekly_return FROM ({_RETURNS})"),
    "join_exact_date": sql("sectoryield", f"SELECT price_date, gics_sector_name, {rnd('r', 6)} AS sector_return, {rnd('chg', 6)} AS yield_change FROM sectoryield"),
    "latest_per_entity": sql("prices", f"SELECT p.company_id, p.price_date, {rnd('p.close_price', 6)} AS close_price FROM prices p JOIN (SELECT company_id, MAX(price_date) AS d FROM prices GROUP BY 1) l ON p.company_id=l.company_id AND p.price_date=l.d"),
    "align_frequencies": sql("coverrate", f"SELECT company_id, year, {rnd('icr', 6)} AS icr, {rnd('policy_rate', 6)} AS policy_rate FROM coverrate"),
    # aggregates
    "agg_basic": sql("debtratio", f"""
SELECT year, country_id, COUNT(*) AS firms, {rnd('SUM(total_debt)', 2)} AS debt, {rnd('AVG(debt_ratio)', 6)} AS mean_ratio, {rnd('MIN(debt_ratio)', 6)} AS min_ratio, {rnd('MAX(debt_ratio)', 6)} AS max_ratio FROM debtratio GROUP BY 1, 2"""),
    "agg_count_distinct": sql("macro", "SELECT country_id, COUNT(DISTINCT indicator_name) AS indicators FROM macro GROUP BY 1"),
    "agg_conditional": sql("cover", f"""
SELECT year, COUNT(*) AS firms, SUM(CASE WHEN icr < 1.5 THEN 1 ELSE 0 END)::BIGINT AS low_firms, {rnd('SUM(CASE WHEN icr < 1.5 THEN total_debt ELSE 0 END)', 2)} AS low_debt FROM cover GROUP BY 1"""),
    "agg_share_pct": sql("cover", f"SELECT country_id, COUNT(*) AS firms, {rnd('SUM(CASE WHEN icr < 1.5 THEN 1 ELSE 0 END)*100.0/COUNT(*)', 1)} AS low_pct FROM cover GROUP BY 1"),
    "agg_listagg": sql("companies", "SELECT country_id, string_agg(DISTINCT gics_sector_name, ', ' ORDER BY gics_sector_name) AS sectors, COUNT(*) AS companies FROM companies GROUP BY 1"),
    "agg_covariance": sql("sectorcpi sectoryield", f"""
SELECT a.gics_sector_name, a.months, {rnd('a.c', 6)} AS cpi_covariance, {rnd('b.c', 6)} AS rate_covariance
FROM (SELECT gics_sector_name, COUNT(*) AS months, AVG(ret*cpi_change)-AVG(ret)*AVG(cpi_change) AS c FROM sectorcpi WHERE cpi_change IS NOT NULL GROUP BY 1) a
JOIN (SELECT gics_sector_name, AVG(r*chg)-AVG(r)*AVG(chg) AS c FROM sectoryield GROUP BY 1) b ON a.gics_sector_name=b.gics_sector_name"""),
    "agg_correlation": sql("annual", f"""
SELECT company_id, years, CASE WHEN vx > 0 AND vy > 0 THEN {rnd('cov/(SQRT(vx)*SQRT(vy))', 6)} END AS correlation, CAST(NULL AS DOUBLE) AS constant_correlation
FROM (SELECT company_id, COUNT(*) AS years, COVAR_POP(ebitda, interest_expense) AS cov, VAR_POP(ebitda) AS vx, VAR_POP(interest_expense) AS vy FROM annual WHERE interest_expense IS NOT NULL GROUP BY 1)"""),
    "agg_stddev": sql("prices", f"SELECT company_id, COUNT(total_return) AS weeks, {rnd('SQRT(GREATEST(AVG(total_return*total_return)-AVG(total_return)*AVG(total_return),0))', 4)} AS return_sigma FROM prices GROUP BY 1"),
    "lag_of_aggregate": sql("trend", f"SELECT country_id, year, {rnd('gdp_growth', 6)} AS gdp_growth, {rnd('gdp_change', 6)} AS gdp_change FROM trend"),
    "agg_max_by": sql("annual", "SELECT company_id, MAX(revenue) AS best_revenue, year(arg_max(period_end_date, revenue)) AS best_year FROM annual GROUP BY 1"),
    "pivot_regime": sql("sectormonth cpi", f"""
SELECT gics_sector_name, {rnd("COALESCE(AVG(CASE WHEN cpi_yoy > 3 THEN r*52 END),0)", 6)} AS high_inflation, {rnd("COALESCE(AVG(CASE WHEN NOT cpi_yoy > 3 THEN r*52 END),0)", 6)} AS low_inflation
FROM sectormonth s JOIN cpi c ON s.m=c.m WHERE gics_sector_name IS NOT NULL GROUP BY 1"""),
    "agg_rate_by_year": sql("rates", f"SELECT year(rate_date) AS year, {rnd('AVG(rate_value)', 6)} AS rate FROM rates WHERE country_id='US' AND rate_type='10Y_YIELD' GROUP BY 1"),
    # windows
    "lag_features": sql("annual", """
SELECT a.company_id, a.period_end_date, a.total_debt, b.total_debt AS total_debt_lag1, c.total_debt AS total_debt_lag2
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY company_id ORDER BY period_end_date) AS i FROM annual) a
LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY company_id ORDER BY period_end_date) AS i FROM annual) b ON a.company_id=b.company_id AND b.i=a.i-1
LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY company_id ORDER BY period_end_date) AS i FROM annual) c ON a.company_id=c.company_id AND c.i=a.i-2"""),
    "growth_yoy_lag12": sql("monthly", f"""
SELECT country_id, m AS indicator_date, {rnd('(x-px)/px*100', 6)} AS yoy FROM (SELECT country_id, m, v/n AS x, LAG(v/n,12) OVER (PARTITION BY country_id ORDER BY m) AS px FROM monthly)"""),
    "diff_series": sql("rates", f"SELECT country_id, rate_type, rate_date, {rnd('rate_value - LAG(rate_value) OVER (PARTITION BY country_id, rate_type ORDER BY rate_date)', 6)} AS change FROM rates"),
    "lag_quarters": sql("housing", f"""
SELECT country_id, year(qs) || '-Q' || quarter(qs) AS year_quarter, {rnd('starts', 6)} AS starts, {rnd('LAG(starts,2) OVER (PARTITION BY country_id ORDER BY year(qs), quarter(qs))', 6)} AS starts_lag2 FROM housing"""),
    "streak_persistence": sql("streaks", "SELECT company_id, year, CAST(streak AS BIGINT) AS streak FROM streaks"),
    "monotone_decline": sql("annual", """
SELECT company_id, period_end_date, CASE WHEN p2 IS NOT NULL THEN CASE WHEN total_debt < p1 AND p1 < p2 THEN CAST(1 AS BIGINT) ELSE 0 END END AS declining
FROM (SELECT *, LAG(total_debt,1) OVER w AS p1, LAG(total_debt,2) OVER w AS p2 FROM annual WINDOW w AS (PARTITION BY company_id ORDER BY period_end_date))"""),
    "ntile_quartiles": sql("sales", """
SELECT company_id, revenue, NTILE(4) OVER (ORDER BY revenue, company_id) AS quartile FROM (SELECT company_id, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM sales GROUP BY 1)"""),
    "leadlag_profile": sql("sectorcpi", f"""
SELECT gics_sector_name, lag, windows, mean_correlation, ROW_NUMBER() OVER (PARTITION BY gics_sector_name ORDER BY ABS(mean_correlation) DESC NULLS LAST, lag) AS lag_rank
FROM (SELECT gics_sector_name, lag, COUNT(*) AS windows, {rnd('AVG(corr)', 6)} AS mean_correlation FROM (
  SELECT a.gics_sector_name, a.lag, a.i, {_POP_CORR.format(x='b.ret', y='b.c')} AS corr FROM lagrows a JOIN lagrows b ON a.gics_sector_name=b.gics_sector_name AND a.lag=b.lag AND b.i BETWEEN a.i-11 AND a.i
  GROUP BY 1, 2, 3 HAVING COUNT(*) = 12) GROUP BY 1, 2)""").replace("\nSELECT gics_sector_name, lag, windows", """,
cpil AS (SELECT *, LAG(cpi_change,1) OVER w AS c1, LAG(cpi_change,2) OVER w AS c2, LAG(cpi_change,3) OVER w AS c3 FROM sectorcpi WINDOW w AS (PARTITION BY gics_sector_name ORDER BY m)),
laglong AS (SELECT gics_sector_name, m, ret, 0 AS lag, cpi_change AS c FROM cpil UNION ALL SELECT gics_sector_name, m, ret, 1, c1 FROM cpil UNION ALL SELECT gics_sector_name, m, ret, 2, c2 FROM cpil UNION ALL SELECT gics_sector_name, m, ret, 3, c3 FROM cpil),
lagrows AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY gics_sector_name, lag ORDER BY m) AS i FROM laglong WHERE c IS NOT NULL)
SELECT gics_sector_name, CAST(lag AS BIGINT) AS lag, windows""", 1),
    # sorts
    "sort_multi_key": sql("firms", "SELECT year, gics_sector_name, COUNT(*) AS firms FROM firms GROUP BY 1, 2 ORDER BY 1, 3 DESC, 2"),
    "topk_global": sql("companies", "SELECT gics_sector_name, COUNT(*) AS cnt FROM companies WHERE gics_sector_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 6"),
    # views
    "view_company_details": sql("companies countries", """
SELECT company_id, ticker, company_name, c.country_id, country_name, c.currency, gics_sector_name, gics_industry_group_name, is_active FROM companies c LEFT JOIN countries n ON c.country_id=n.country_id"""),
    "view_financials_annual": sql("annual companies", f"""
SELECT a.*, ticker, company_name, country_id, gics_sector_name, CASE WHEN interest_expense > 0 THEN {rnd('ebitda/interest_expense', 6)} END AS interest_coverage_ratio,
  CASE WHEN revenue > 0 THEN {rnd('gross_profit/revenue', 6)} END AS gross_margin FROM annual a JOIN companies USING (company_id)"""),
    "view_index_members": sql("membership companies", """
SELECT index_id, CASE index_id WHEN 'SPX' THEN 'S&P 500' ELSE 'FTSE 100' END AS index_name, company_id, as_of_date, ticker, company_name, country_id, gics_sector_name,
 CAST(weight AS DOUBLE) AS weight, CAST(shares_outstanding AS DOUBLE) AS shares_outstanding, CAST(price AS DOUBLE) AS price FROM membership JOIN companies USING (company_id)"""),
    "view_macro_country": sql("macro countries", f"""
SELECT m.country_id, indicator_date, indicator_name, bloomberg_ticker, {rnd('indicator_value', 6)} AS indicator_value, indicator_category, country_name, currency FROM macro m JOIN countries c ON m.country_id=c.country_id"""),
    # studies
    "q_uc1_q1_top10_concentration": sql("ukx companies gdp", f"""
SELECT t.year, {rnd('t.w', 2)} AS top10_weight_pct, {rnd('g.gdp_growth', 2)} AS uk_gdp_growth_pct, t.names AS top10_companies
FROM (SELECT year, CAST(SUM(weight) AS DOUBLE) AS w, string_agg(company_name, ', ' ORDER BY rank) AS names FROM ({_TOP10}) JOIN companies USING (company_id) WHERE rank <= 10 GROUP BY year) t
LEFT JOIN gdp g ON t.year=g.year AND g.country_id='GB'"""),
    "q_uc1_q2_hhi": sql("ukx prices", f"SELECT h.*, {rnd('r.r*52', 2)} AS approx_annual_return_pct FROM ({_HHI}) h LEFT JOIN ({_RETURNS}) r ON h.year=r.year"),
    "q_uc1_q3_index_churn": sql("changes companies", "SELECT year, status, COUNT(*) AS company_count, string_agg(company_name, ', ' ORDER BY company_name) AS companies FROM changes JOIN companies USING (company_id) GROUP BY 1, 2"),
    "q_uc2_q1_leverage_distribution": sql("debtratio", _leverage(True)),
    "q_uc2_q2_deleveraging": sql("decline phase", f"""
SELECT d.year, p.gdp_phase, COUNT(*) AS total_companies, CAST(SUM(falling) AS BIGINT) AS deleveraging_companies, {rnd('SUM(falling)*100.0/COUNT(*)', 1)} AS deleveraging_pct
FROM decline d LEFT JOIN phase p ON d.year=p.year AND d.country_id=p.country_id GROUP BY 1, 2"""),
    "q_uc2_q3_rate_sensitivity": sql("rollcorr coverrate", _SENSITIVE + " LIMIT 50"),
    "q_uc3_q1_zombies": sql("streaks trend", f"""
SELECT z.year, z.country_id, COUNT(*) AS total_companies_analyzed, SUM(CASE WHEN streak >= 3 THEN 1 ELSE 0 END)::BIGINT AS persistent_zombies,
  {rnd('AVG(gdp_growth)', 2)} AS avg_gdp_growth, {rnd('AVG(gdp_change)', 2)} AS gdp_trend
FROM streaks z LEFT JOIN trend g ON z.country_id=g.country_id AND z.year=g.year WHERE streak >= 3 AND gdp_change < 0 GROUP BY 1, 2"""),
    "q_uc3_q2_rate_shock": sql("shock", f"""
SELECT country_id, COUNT(*) AS total_companies, SUM(CASE WHEN icr >= 1.7 AND shocked < 1.5 THEN 1 ELSE 0 END)::BIGINT AS healthy_to_atrisk,
  SUM(CASE WHEN icr >= 1.5 AND shocked < 1.5 THEN 1 ELSE 0 END)::BIGINT AS newly_distressed, {rnd('AVG(icr)', 2)} AS avg_current_icr, {rnd('AVG(shocked)', 2)} AS avg_shocked_icr,
  {rnd('AVG(icr-shocked)', 2)} AS avg_icr_decline FROM shock GROUP BY 1"""),
    "q_uc3_q3_geo_risk": sql("cover macro", _GEO),
    "q_uc4_q1_housing_lead": sql("qgrowth housing", _housing("qgrowth", "SELECT * FROM housing", "qs")),
    "q_uc4_q2_volatility_quartiles": sql("quartiles", _quartiles(True)),
    "q_uc4_q3_resilience": sql("qgrowth macro", _resilience(
        "qgrowth", "SELECT country_id, CAST(date_trunc('quarter', indicator_date) AS DATE) AS qs, AVG(indicator_value) AS x FROM macro WHERE indicator_name ILIKE '%Real GDP%yoy%' GROUP BY 1, 2 HAVING AVG(indicator_value) < 0",
        "qs", "year(g.qs) || '-Q' || quarter(g.qs) AS year_quarter")),
    "q_uc5_q1_inflation_regime": sql("sectormonth cpi", f"""
SELECT CASE WHEN cpi_yoy > 3 THEN 'High Inflation' ELSE 'Low Inflation' END AS inflation_regime, gics_sector_name, COUNT(*) AS months, {rnd('AVG(cpi_yoy)', 2)} AS avg_cpi,
  {rnd('AVG(r)*4.33', 4)} AS avg_monthly_return_pct, {rnd('AVG(r)*52', 2)} AS annualized_return_pct FROM sectormonth s JOIN cpi c ON s.m=c.m WHERE gics_sector_name IS NOT NULL GROUP BY 1, 2"""),
    "q_uc5_q2_cpi_leadlag": sql("sectorcpi", f"""
SELECT gics_sector_name, months, {rnd('ar', 4)} AS avg_return, {rnd('ac', 4)} AS avg_cpi_change, {rnd('c', 6)} AS return_cpi_covariance,
  CASE WHEN c > 0.001 THEN 'Positive (Inflation Beneficiary)' WHEN c < -0.001 THEN 'Negative (Inflation Sensitive)' ELSE 'Neutral' END AS cpi_sensitivity
FROM (SELECT gics_sector_name, COUNT(*) AS months, AVG(ret) AS ar, AVG(cpi_change) AS ac, AVG(ret*cpi_change)-AVG(ret)*AVG(cpi_change) AS c FROM sectorcpi WHERE cpi_change IS NOT NULL GROUP BY 1)"""),
    "q_uc5_q3_rate_profile": sql("sectoryield", f"""
SELECT gics_sector_name, weeks, {rnd('ar', 4)} AS avg_weekly_return, {rnd('ac', 4)} AS avg_yield_change_bp, {rnd('c', 6)} AS rate_sensitivity,
  CASE WHEN c < -0.001 THEN 'Rate Sensitive (Duration Risk)' WHEN c > 0.001 THEN 'Rate Beneficiary' ELSE 'Rate Neutral' END AS rate_profile
FROM (SELECT gics_sector_name, COUNT(*) AS weeks, AVG(r) AS ar, AVG(chg) AS ac, AVG(r*chg)-AVG(r)*AVG(chg) AS c FROM sectoryield GROUP BY 1)"""),
    # variants
    "q_v_uc1_q1_export": sql("ukx", f"SELECT year, CAST(SUM(weight) AS DOUBLE) AS top10_weight_pct, COUNT(*) AS top10_count FROM ({_TOP10}) WHERE rank <= 10 GROUP BY 1"),
    "q_v_uc1_q2_export": sql("ukx", _HHI),
    "q_v_uc1_q3_pivot": sql("ukx changes", _CHURN),
    "q_v_uc2_q1_export": sql("debtratio", _leverage(False)),
    "q_v_uc2_q2_by_sector": sql("debtratio", """
SELECT year, gics_sector_name, COUNT(*) AS deleveraging_companies, COUNT(*) AS count_by_sector
FROM (SELECT *, LAG(debt_ratio,1) OVER w AS p1, LAG(debt_ratio,2) OVER w AS p2 FROM debtratio WINDOW w AS (PARTITION BY company_id ORDER BY year)) WHERE debt_ratio < p1 AND p1 < p2 GROUP BY 1, 2"""),
    "q_v_uc2_q2_by_year": sql("decline", f"SELECT year, COUNT(*) AS companies, CAST(SUM(falling) AS BIGINT) AS deleveraging, {rnd('SUM(falling)*100.0/COUNT(*)', 1)} AS pct FROM decline GROUP BY 1"),
    "q_v_uc2_q3_semi": sql("rollcorr coverrate", f"""
SELECT (SELECT ANY_VALUE(company_name) FROM coverrate c WHERE c.company_id=r.company_id) AS company_name, MAX(year) AS latest_year, {rnd('arg_max(corr, year)', 4)} AS rolling_correlation
FROM rollcorr r WHERE company_id IN (SELECT company_id FROM coverrate GROUP BY 1 HAVING COUNT(*) >= {RATE_YEARS}) GROUP BY r.company_id"""),
    "q_v_uc3_q1_by_sector": sql("cover", "SELECT year, gics_sector_name, COUNT(*) AS zombie_count FROM cover WHERE icr < 1.5 GROUP BY 1, 2"),
    "q_v_uc3_q1_all": sql("financials companies", """
SELECT year, country_id, COUNT(*) AS total, SUM(CASE WHEN streak >= 3 THEN 1 ELSE 0 END)::BIGINT AS zombies
FROM (SELECT *, flag + COALESCE(LAG(flag,1) OVER w,0) + COALESCE(LAG(flag,2) OVER w,0) AS streak
  FROM (SELECT company_id, country_id, period_end_date, period_type, year(period_end_date) AS year, CASE WHEN interest_expense > 0 AND ebitda/interest_expense < 1.5 THEN 1 ELSE 0 END AS flag
        FROM financials JOIN companies USING (company_id) WHERE gics_sector_name <> 'Financials')
  WINDOW w AS (PARTITION BY company_id ORDER BY period_end_date, period_type)) GROUP BY 1, 2"""),
    "q_v_uc2_q3_export": sql("rollcorr coverrate", _SENSITIVE + " LIMIT 100"),
    "q_v_uc3_q2_report": sql("shock", f"""
SELECT country_id, COUNT(*) AS total_companies, SUM(CASE WHEN icr >= 1.5 AND shocked < 1.5 THEN 1 ELSE 0 END)::BIGINT AS newly_distressed,
  {rnd('AVG(icr)', 2)} AS avg_current_icr, {rnd('AVG(shocked)', 2)} AS avg_shocked_icr FROM shock WHERE total_debt > 0 GROUP BY 1"""),
    "q_v_uc3_q3_report": sql("cover macro", _GEO),
    "q_v_uc4_q2_report": sql("quartiles", _quartiles(True)),
    "q_v_uc1_q2_report": sql("ukx", """
SELECT year, COUNT(*) AS num_members, CASE WHEN SUM(w * w) < 0.15 THEN 'Unconcentrated' WHEN SUM(w * w) < 0.25 THEN 'Moderately Concentrated' ELSE 'Highly Concentrated' END AS concentration_level
FROM (SELECT year, CAST(weight AS DOUBLE) / 100 AS w FROM ukx WHERE weight IS NOT NULL) GROUP BY 1"""),
    "q_v_uc3_q2_min10": sql("shock", f"""
SELECT country_id, COUNT(*) AS companies, {rnd('AVG(icr)', 2)} AS current_icr, {rnd('AVG(shocked)', 2)} AS shocked_icr, SUM(CASE WHEN icr >= 1.5 AND shocked < 1.5 THEN 1 ELSE 0 END)::BIGINT AS newly_distressed
FROM shock GROUP BY 1 HAVING COUNT(*) >= 10"""),
    "q_v_uc4_q1_annual": sql("growth macro", _housing("growth", "SELECT country_id, year(indicator_date) AS year, AVG(indicator_value) AS starts FROM macro WHERE indicator_name ILIKE '%Housing Start%' GROUP BY 1, 2", "year")),
    "q_v_uc4_q2_export": sql("quartiles", _quartiles(False)),
    "vol_by_sector_full_history": sql("growth", f"""
SELECT gics_sector_name, COUNT(*) AS companies, {rnd('AVG(vol)', 6)} AS avg_vol, {rnd('MIN(vol)', 6)} AS min_vol, {rnd('MAX(vol)', 6)} AS max_vol
FROM (SELECT company_id, gics_sector_name, SQRT(ABS(AVG(growth*growth)-AVG(growth)*AVG(growth))) AS vol FROM growth WHERE growth IS NOT NULL AND gics_sector_name IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) >= {MIN_YEARS}) GROUP BY 1"""),
    "q_v_uc4_q3_annual": sql("growth gdp", _resilience("growth", "SELECT country_id, year, gdp_growth AS x FROM gdp WHERE gdp_growth < 0", "year", "g.year")),
    "q_v_uc5_q1_yoy_regime": sql("macro", f"""
SELECT CASE WHEN yoy > 3 THEN 'High Inflation' ELSE 'Low Inflation' END AS regime, COUNT(*) AS months, {rnd('AVG(yoy)', 2)} AS avg_cpi_yoy
FROM (SELECT (indicator_value-p)/NULLIF(p,0)*100 AS yoy FROM (SELECT *, LAG(indicator_value,12) OVER (PARTITION BY country_id, bloomberg_ticker ORDER BY indicator_date) AS p FROM macro WHERE indicator_category='CPI' AND indicator_name ILIKE '%CPI%'))
WHERE yoy IS NOT NULL GROUP BY 1"""),
    "q_v_uc5_q1_report": sql("sectormonth cpi", f"SELECT CASE WHEN cpi_yoy > 3 THEN 'High Inflation' ELSE 'Low Inflation' END AS regime, gics_sector_name, {rnd('AVG(r*52)', 2)} AS avg_annual_return FROM cpi JOIN sectormonth USING (m) GROUP BY 1, 2"),
    # extensions
    "ext_hierarchy_rollup": sql("companies", """
SELECT gics_sector_name, gics_industry_group_name, gics_industry_name, gics_sub_industry_name,
 CAST(GROUPING(gics_sector_name, gics_industry_group_name, gics_industry_name, gics_sub_industry_name) AS BIGINT) AS level, COUNT(*) AS companies, CAST(SUM(cap) AS DOUBLE) AS market_cap
FROM companies GROUP BY ROLLUP (gics_sector_name, gics_industry_group_name, gics_industry_name, gics_sub_industry_name)"""),
    "ext_hierarchy_recursive": sql("companies", """
, tree AS (SELECT company_id AS node, company_id AS ancestor, 0 AS distance FROM companies
  UNION ALL SELECT node, ancestor // 2, distance + 1 FROM tree WHERE ancestor > 0),
sums AS (SELECT ancestor AS company_id, COUNT(*) AS members, CAST(SUM(cap) AS DOUBLE) AS market_cap FROM tree JOIN companies ON company_id = node GROUP BY 1)
SELECT company_id, depth, members, market_cap FROM sums JOIN (SELECT node AS company_id, MAX(distance) AS depth FROM tree GROUP BY 1) USING (company_id)""").replace("WITH ", "WITH RECURSIVE ", 1).replace("\n, tree", ", tree"),
    "ext_membership_flag_lag": sql("ukx", f"""
SELECT y.year, COUNT(*) FILTER (y.year > {FIRST_YEAR} AND f AND NOT p) AS joined, COUNT(*) FILTER (y.year > {FIRST_YEAR} AND p AND NOT f) AS left_index, COUNT(*) FILTER (y.year > {FIRST_YEAR} AND p AND f) AS stayed
FROM (SELECT c.company_id, g.year, EXISTS (SELECT 1 FROM ukx u WHERE u.company_id=c.company_id AND u.year=g.year) AS f, EXISTS (SELECT 1 FROM ukx u WHERE u.company_id=c.company_id AND u.year=g.year-1) AS p
      FROM (SELECT DISTINCT company_id FROM ukx) c, (SELECT unnest(range({FIRST_YEAR}, {LAST_YEAR} + 1)) AS year) g) y GROUP BY 1"""),
    "ext_churn_size_compare": sql("ukx", f"""
SELECT a.year, CASE WHEN b.company_id IS NULL THEN 'LEAVER' ELSE 'STAYER' END AS status, COUNT(*) AS members, {rnd('AVG(a.price*a.shares_outstanding)', 2)} AS avg_size
FROM ukx a LEFT JOIN ukx b ON a.company_id=b.company_id AND b.year=a.year+1 WHERE a.year < {LAST_YEAR} GROUP BY 1, 2"""),
    "ext_rolling_beta": sql("sectoryield", f"""
SELECT gics_sector_name, COUNT(*) AS windows, {rnd('arg_max(beta, price_date)', 6)} AS latest_beta, {rnd('MIN(beta)', 6)} AS min_beta, {rnd('MAX(beta)', 6)} AS max_beta
FROM (SELECT gics_sector_name, price_date, COUNT(*) OVER w AS n, COVAR_POP(r, chg) OVER w / NULLIF(VAR_POP(chg) OVER w, 0) AS beta FROM sectoryield
  WINDOW w AS (PARTITION BY gics_sector_name ORDER BY price_date ROWS BETWEEN 103 PRECEDING AND CURRENT ROW)) WHERE n = 104 GROUP BY 1"""),
    "ext_weighted_return": sql("prices companies", f"""
SELECT strftime(price_date, '%Y-%m') AS year_month, gics_sector_name,
  {rnd('SUM(CASE WHEN cap > 0 THEN total_return*CAST(cap AS DOUBLE) END)/NULLIF(SUM(CASE WHEN cap > 0 AND total_return IS NOT NULL THEN CAST(cap AS DOUBLE) END),0)', 6)} AS weighted_return, {rnd('AVG(total_return)', 6)} AS equal_return
FROM prices JOIN companies USING (company_id) WHERE gics_sector_name IS NOT NULL GROUP BY 1, 2"""),
    "ext_lead_persistence": sql("cover", """
SELECT year, COUNT(*) AS firms, SUM(CASE WHEN icr < 1.5 AND n1 < 1.5 AND n2 < 1.5 THEN 1 ELSE 0 END)::BIGINT AS persistent
FROM (SELECT *, LEAD(icr,1) OVER w AS n1, LEAD(icr,2) OVER w AS n2 FROM cover WINDOW w AS (PARTITION BY company_id ORDER BY year)) WHERE n2 IS NOT NULL GROUP BY 1"""),
    "ext_trend_slope": sql("gdp", f"""
SELECT a.country_id, a.year, {rnd('ANY_VALUE(a.gdp_growth)', 6)} AS gdp_growth, {rnd('(3*SUM(b.year*b.gdp_growth)-SUM(b.year)*SUM(b.gdp_growth))/(3*SUM(b.year*b.year)-SUM(b.year)*SUM(b.year))', 6)} AS slope
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY country_id ORDER BY year) AS i FROM gdp) a JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY country_id ORDER BY year) AS i FROM gdp) b ON a.country_id=b.country_id AND b.i BETWEEN a.i-2 AND a.i
GROUP BY 1, 2 HAVING COUNT(*) = 3"""),
    "ext_concentration_gdp": sql("ukx gdp", f"""
SELECT country_id, COUNT(*) AS years, {rnd('COVAR_POP(w, gdp_growth)/NULLIF(STDDEV_POP(w)*STDDEV_POP(gdp_growth), 0)', 6)} AS correlation
FROM gdp JOIN (SELECT year, CAST(SUM(weight) AS DOUBLE) AS w FROM ({_TOP10}) WHERE rank <= 10 GROUP BY 1) t USING (year) GROUP BY 1"""),
    "ext_asof_available": sql("prices financials", _ASOF),
    "ext_asof_sliced": sql("prices financials", _ASOF),
    "ext_percentiles": sql("debtratio", "SELECT year, COUNT(*) AS n, " + ", ".join(f"{rnd(f'quantile_cont(debt_ratio, {q})', 6)} AS {n}" for n, q in (("p10", 0.1), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9))) + " FROM debtratio GROUP BY 1"),
    "ext_housing_corr": sql("qgrowth housing", f"""
SELECT gics_sector_name, CAST(lag AS BIGINT) AS lag, COUNT(*) AS cells, {rnd(_POP_CORR.format(x='starts', y='g'), 6)} AS correlation
FROM (SELECT gics_sector_name, country_id, qs, AVG(growth) AS g FROM qgrowth WHERE growth IS NOT NULL AND gics_sector_name IN ('Consumer Discretionary','Materials','Industrials') GROUP BY 1, 2, 3) s
JOIN (SELECT a.country_id, a.qs, l.lag, b.starts FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY country_id ORDER BY qs) AS i FROM housing) a, (SELECT unnest([0,1,2,3,4]) AS lag) l,
   (SELECT *, ROW_NUMBER() OVER (PARTITION BY country_id ORDER BY qs) AS i FROM housing) b WHERE a.country_id=b.country_id AND b.i=a.i-l.lag) h ON s.country_id=h.country_id AND s.qs=h.qs
GROUP BY 1, 2"""),
    "ext_quartile_by_phase": sql("quartiles growth phase", f"""
SELECT quartile AS volatility_quartile, gdp_phase, COUNT(*) AS observations, {rnd('AVG(growth)', 4)} AS avg_growth
FROM growth g JOIN quartiles q ON g.company_id=q.company_id JOIN phase p ON g.country_id=p.country_id AND g.year=p.year WHERE growth IS NOT NULL GROUP BY 1, 2"""),
    "ext_compound_return": sql("prices", f"""
SELECT company_id, year(price_date) AS year, COUNT(*) AS weeks, {rnd('(PRODUCT(1+total_return/100)-1)*100', 4)} AS compound_return_pct, {rnd('SUM(total_return)', 4)} AS summed_return_pct
FROM prices WHERE total_return IS NOT NULL GROUP BY 1, 2"""),
}
