"""Independent SQL for the registered queries, written from the definitions.

It joins months to contracts by range, counts distinct accounts directly and deduplicates step by
step, so it shares no plan with the library.
"""

from __future__ import annotations

import datetime as dt

from verification.fixtures import AS_OF, CHANGES, CONTRACT_COLUMNS, EARLY_AS_OF, LONG_CHANGES, PACKAGES
from waterline.config import TIER_SEGMENTS

_IN_PACKAGES = ", ".join(f"'{p}'" for p in PACKAGES)
_BRIDGE = ", ".join(f"('{t}', {c})" for t, codes in TIER_SEGMENTS.items() for c in codes)
_CHANGES = ", ".join(
    f"({i}, '{c.package}', DATE '{c.effective_date}', CAST({c.old_price} AS DECIMAL(18,2)),"
    f" CAST({c.new_price} AS DECIMAL(18,2)))"
    for i, c in enumerate(CHANGES, 1)
)
_STAR = """
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""

HEAD = f"""
contracts AS (SELECT {CONTRACT_COLUMNS.replace('as string', 'as varchar')} {_STAR})"""

BUSINESS = f"""
opened AS (
  SELECT * REPLACE (CASE WHEN year(end_date) >= 2999 THEN NULL ELSE end_date END AS end_date)
  FROM contracts),
business AS (
  SELECT *,
    CAST(CAST(start_date - CAST(dayofweek(start_date) AS INTEGER) AS DATE) AS VARCHAR) AS week_key,
    strftime(start_date, '%Y-%m') AS month_key,
    concat(CAST(year(start_date) AS VARCHAR), 'Q', CAST(quarter(start_date) AS VARCHAR))
      AS quarter_key,
    CAST(year(start_date) AS VARCHAR) AS year_key
  FROM opened
  WHERE package_group IN ({_IN_PACKAGES}) AND test_flag = 0
    AND (end_date IS NULL OR start_date <= end_date))"""
CONTRACTS = f"{HEAD},{BUSINESS}"

SITES = """
site_rows AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS site,
    strftime(CAST(DATE '1994-06-01' + CAST(s_suppkey % 90 AS INT) * INTERVAL '1' MONTH AS DATE),
             '%Y-%m') AS month,
    CAST(segment AS INT) AS cxn_code, CAST((s_suppkey * 7 + segment * 13) % 200 AS BIGINT) AS base
  FROM supplier, range(1, 54) AS s(segment))"""


def prep(as_of: dt.date = AS_OF, head: str = HEAD) -> str:
    return f"""{head},{BUSINESS},
gone AS (
  SELECT account_number, min(end_date) AS churn_date FROM business GROUP BY account_number
  HAVING NOT bool_or(
      (wo_type_group = 'Activate' AND (end_date IS NULL OR end_date > DATE '{as_of}'))
      OR wo_type_group = 'Change of Service' OR start_date >= DATE '{as_of}')
    AND min(end_date) < DATE '{as_of}' - INTERVAL '30' DAY),
flagged AS (
  SELECT b.*, CASE WHEN g.account_number IS NULL THEN 0 ELSE 1 END AS churn_flag, g.churn_date
  FROM business b LEFT JOIN gone g USING (account_number)),
categorised AS (
  SELECT *, CASE WHEN churn_flag = 1 THEN 'Churn'
    WHEN wo_type_group = 'Change of Service' AND reason_group = 'Upgrade' THEN 'Expansion'
    WHEN wo_type_group = 'Change of Service' AND reason_group = 'Downgrade' THEN 'Contraction'
    WHEN wo_type_group = 'Activate' THEN 'New MRR' ELSE 'Other' END AS revenue_category
  FROM flagged),
tagged AS (SELECT * FROM categorised WHERE revenue_category <> 'Other'),
conflict_keys AS (
  SELECT account_number, package_group, month_key FROM tagged
  GROUP BY ALL HAVING count(DISTINCT revenue_category) > 1),
step1 AS (
  SELECT t.* FROM tagged t ANTI JOIN conflict_keys USING (account_number, package_group, month_key)
  UNION ALL
  SELECT t.* FROM tagged t SEMI JOIN conflict_keys USING (account_number, package_group, month_key)
  QUALIFY row_number() OVER (
    PARTITION BY account_number, package_group, month_key
    ORDER BY CASE revenue_category WHEN 'New MRR' THEN 1 WHEN 'Expansion' THEN 2
               WHEN 'Contraction' THEN 3 WHEN 'Other' THEN 4 ELSE 5 END,
      start_date, end_date DESC NULLS LAST, price, wo_type_group, reason_group, cxn_code, site,
      order_key, line_number, part_key) = 1),
deduped AS (
  SELECT * FROM step1
  QUALIFY row_number() OVER (
    PARTITION BY account_number, package_group, start_date
    ORDER BY end_date DESC NULLS LAST, price, wo_type_group, reason_group, cxn_code, site,
      order_key, line_number, part_key) = 1)"""


BRIDGE = f"bridge(tier, cxn_code) AS (VALUES {_BRIDGE})"


def tiered(source: str = "deduped") -> str:
    return f"""{BRIDGE},
tiered AS (
  SELECT 'Full' AS tier, * FROM {source}
  UNION ALL BY NAME SELECT b.tier, d.* FROM {source} d JOIN bridge b USING (cxn_code))"""


def splits(as_of: dt.date = AS_OF) -> str:
    """Deduplicated rows repriced and cut, as ``split``; one conditional per change, in order."""
    price = "price"
    for c in CHANGES:
        price = (
            f"(CASE WHEN package_group = '{c.package}' AND start_date >= DATE '{c.effective_date}'"
            f" AND {price} = {c.old_price} THEN CAST({c.new_price} AS DECIMAL(18,2))"
            f" ELSE {price} END)"
        )
    return f"""{prep(as_of)},
changes(seq, package, eff, old, new) AS (VALUES {_CHANGES}),
repriced AS (SELECT * REPLACE ({price} AS price) FROM deduped),
numbered AS (SELECT *, row_number() OVER () AS rid FROM repriced),
cuts AS (
  SELECT n.rid, c.eff, c.new FROM numbered n JOIN changes c
    ON n.package_group = c.package AND n.price = c.old
      AND n.start_date < c.eff AND c.eff < n.end_date),
edges AS (
  SELECT rid, start_date AS from_date, price FROM numbered
  UNION ALL SELECT rid, eff, new FROM cuts),
periods AS (
  SELECT e.rid, e.from_date, e.price,
    lead(e.from_date) OVER (PARTITION BY e.rid ORDER BY e.from_date) AS next_date
  FROM edges e),
split AS (
  SELECT n.* REPLACE (p.from_date AS start_date, p.price AS price,
    CASE WHEN p.next_date IS NULL THEN n.end_date ELSE p.next_date - 1 END AS end_date)
  FROM periods p JOIN numbered n USING (rid))"""


def long_splits() -> str:
    """As ``splits``, for a change per order; prices follow their changes one by one. Recursive."""
    return f"""{prep()},
changes(seq, package, eff, old, new) AS ({LONG_CHANGES}),
arrived AS (SELECT *, row_number() OVER () AS rid FROM deduped),
walk AS (
  SELECT rid, package_group, start_date, price, CAST(0 AS BIGINT) AS seq FROM arrived
  UNION ALL
  SELECT w.rid, w.package_group, w.start_date, arg_min(c.new, c.seq), min(c.seq)
  FROM walk w JOIN changes c
    ON c.package = w.package_group AND c.old = w.price AND c.eff <= w.start_date AND c.seq > w.seq
  GROUP BY w.rid, w.package_group, w.start_date),
numbered AS (
  SELECT a.* REPLACE (w.price AS price)
  FROM arrived a JOIN (SELECT rid, arg_max(price, seq) AS price FROM walk GROUP BY rid) w USING (rid)),
days AS (SELECT package, old, eff, arg_max(new, seq) AS new FROM changes GROUP BY ALL),
edges AS (
  SELECT rid, start_date AS from_date, price FROM numbered
  UNION ALL
  SELECT n.rid, d.eff, d.new FROM numbered n JOIN days d
    ON n.package_group = d.package AND n.price = d.old AND n.start_date < d.eff AND d.eff < n.end_date),
periods AS (
  SELECT rid, from_date, price, lead(from_date) OVER (PARTITION BY rid ORDER BY from_date) AS next_date FROM edges),
split AS (
  SELECT n.* REPLACE (p.from_date AS start_date, p.price AS price,
    CASE WHEN p.next_date IS NULL THEN n.end_date ELSE p.next_date - 1 END AS end_date)
  FROM periods p JOIN numbered n USING (rid))"""


def start_new(as_of: dt.date = AS_OF) -> str:
    """Needs ``tiered``."""
    return f"""
run AS (
  SELECT *, coalesce(end_date, DATE '{as_of}') AS stop, CAST(price * 100 AS BIGINT) AS cents
  FROM tiered),
spine AS (
  SELECT tier, CAST(m AS DATE) AS m0, last_day(CAST(m AS DATE)) AS m1,
    day(last_day(CAST(m AS DATE))) AS dim
  FROM (SELECT tier, unnest(generate_series(
          date_trunc('month', min(start_date)), date_trunc('month', max(stop)), INTERVAL '1' MONTH))
          AS m
        FROM run GROUP BY tier)),
starting AS (
  SELECT s.tier, s.m0,
    sum(r.cents * CASE WHEN r.stop >= s.m1 THEN s.dim ELSE r.stop - s.m0 + 1 END) AS num,
    count(DISTINCT r.account_number) AS accounts
  FROM spine s JOIN run r ON r.tier = s.tier AND r.start_date <= s.m0 AND r.stop >= s.m0
  GROUP BY s.tier, s.m0),
fresh AS (
  SELECT s.tier, s.m0,
    sum(r.cents * CASE WHEN r.start_date = s.m0 AND r.stop >= s.m1 THEN s.dim
      WHEN least(r.stop, s.m1) >= r.start_date THEN least(r.stop, s.m1) - r.start_date + 1
      ELSE 0 END) AS num,
    count(DISTINCT r.account_number) AS accounts
  FROM spine s JOIN run r ON r.tier = s.tier AND r.start_date BETWEEN s.m0 AND s.m1
  GROUP BY s.tier, s.m0),
start_new AS (
  SELECT s.tier, strftime(s.m0, '%Y-%m') AS month,
    CAST(coalesce(a.num, 0) AS DOUBLE) / CAST(s.dim * 100 AS DOUBLE) AS starting_mrr,
    CAST(coalesce(f.num, 0) AS DOUBLE) / CAST(s.dim * 100 AS DOUBLE) AS new_mrr,
    coalesce(f.accounts, 0) AS new_count, coalesce(a.accounts, 0) AS starting_count
  FROM spine s LEFT JOIN starting a USING (tier, m0) LEFT JOIN fresh f USING (tier, m0))"""


def _moves(name: str, reason: str, delta: str) -> str:
    return f"""
{name} AS (
  SELECT tier, month_key AS month, CAST(sum(greatest(coalesce({delta}, 0), 0)) AS DOUBLE) / 100.0
      AS {name}, count(DISTINCT account_number) AS {name}_count
  FROM (SELECT *, CAST(price * 100 AS BIGINT) AS cents, lag(CAST(price * 100 AS BIGINT)) OVER (
          PARTITION BY tier, account_number
          ORDER BY start_date, end_date NULLS FIRST, price, month_key) AS prev
        FROM tiered WHERE wo_type_group = 'Change of Service' AND test_flag = 0
          AND reason_group = '{reason}')
  GROUP BY ALL)"""


EXPANSION = _moves("expansion", "Upgrade", "cents - prev")
CONTRACTION = _moves("contraction", "Downgrade", "prev - cents")
CHURN = """
churn AS (
  SELECT tier, strftime(churn_date, '%Y-%m') AS month,
    CAST(sum(CAST(price * 100 AS BIGINT)) AS DOUBLE) / 100.0 AS churn,
    count(DISTINCT account_number) AS churn_count
  FROM tiered WHERE churn_flag = 1 GROUP BY ALL)"""

WATERFALL = """
flow AS (
  SELECT tier, month, starting_mrr, starting_count, new_mrr, new_count,
    coalesce(expansion, 0) AS expansion, coalesce(expansion_count, 0) AS expansion_count,
    coalesce(contraction, 0) AS contraction, coalesce(contraction_count, 0) AS contraction_count,
    coalesce(churn, 0) AS churn, coalesce(churn_count, 0) AS churn_count
  FROM start_new LEFT JOIN expansion USING (tier, month)
    LEFT JOIN contraction USING (tier, month) LEFT JOIN churn USING (tier, month)),
waterfall AS (
  SELECT *, starting_mrr + net_new_mrr AS ending_mrr, starting_count + net_count AS ending_count,
    CAST(substr(month, 6, 2) AS BIGINT) AS month_number,
    row_number() OVER (PARTITION BY tier ORDER BY month) AS month_sequential
  FROM (SELECT *, new_mrr + expansion - contraction - churn AS net_new_mrr,
          new_count - churn_count AS net_count FROM flow))"""


def waterfall(as_of: dt.date = AS_OF, rows: str | None = None, source: str = "deduped") -> str:
    """CTEs up to ``waterfall``."""
    return ",".join(
        [rows or prep(as_of), tiered(source), start_new(as_of), EXPANSION, CONTRACTION, CHURN,
         WATERFALL]
    )


def _parpu(amount: str, count: str, name: str) -> str:
    return (
        f"CASE WHEN {count} <> 0 THEN {amount} / CAST({count} AS DOUBLE) WHEN {amount} = 0 THEN 0.0"
        f" WHEN {amount} > 0 THEN CAST('inf' AS DOUBLE) ELSE CAST('-inf' AS DOUBLE) END AS {name}"
    )


PARPU = ", ".join(
    _parpu(*x)
    for x in [
        ("starting_mrr", "starting_count", "starting_parpu"),
        ("new_mrr", "new_count", "new_parpu"),
        ("expansion", "expansion_count", "expansion_parpu"),
        ("contraction", "contraction_count", "contraction_parpu"),
        ("churn", "churn_count", "churn_parpu"),
        ("net_new_mrr", "net_count", "net_parpu"),
        ("ending_mrr", "ending_count", "ending_parpu"),
    ]
)


def arpu(key: str) -> str:
    return f"""
arpu AS (
  SELECT tier, {key}, CAST(s AS DOUBLE) / 100.0 AS total_period_activation,
    n AS unique_accounts, CAST((2 * s + n) // (2 * n) AS DOUBLE) / 100.0 AS arpu
  FROM (SELECT tier, {key}, CAST(sum(CAST(price * 100 AS BIGINT)) AS BIGINT) AS s,
          count(DISTINCT account_number) AS n FROM tiered GROUP BY ALL))"""


SITE_METRICS = """
seen AS (SELECT DISTINCT tier, site FROM tiered),
opens AS (
  SELECT tier, month, count(DISTINCT site) AS site_opens
  FROM seen JOIN site_rows USING (site) GROUP BY ALL),
bases AS (
  SELECT e.tier, r.month, CAST(sum(r.base) AS BIGINT) AS base
  FROM seen e JOIN site_rows r USING (site)
  WHERE e.tier = 'Full'
    OR EXISTS (SELECT 1 FROM bridge b WHERE b.tier = e.tier AND b.cxn_code = r.cxn_code)
  GROUP BY ALL)"""

MONTHLY_COLUMNS = """tier, month, month_sequential, month_number, starting_mrr, starting_parpu,
  starting_count, new_mrr, new_count, new_parpu, expansion, expansion_count, expansion_parpu,
  contraction, contraction_count, contraction_parpu, churn, churn_count, churn_parpu, net_new_mrr,
  net_count, net_parpu, ending_mrr, ending_count, ending_parpu, arpu, site_opens, base,
  cumulative_base, take_rate"""


def combined(as_of: dt.date = AS_OF, rows: str | None = None, source: str = "deduped") -> str:
    """CTEs up to ``combined``."""
    return f"""{waterfall(as_of, rows, source)},{arpu('month_key')},{SITES},{SITE_METRICS},
joined AS (
  SELECT w.*, a.arpu, coalesce(o.site_opens, 0) AS site_opens, coalesce(b.base, 0) AS base,
    {PARPU}
  FROM waterfall w LEFT JOIN arpu a ON a.tier = w.tier AND a.month_key = w.month
    LEFT JOIN opens o ON o.tier = w.tier AND o.month = w.month
    LEFT JOIN bases b ON b.tier = w.tier AND b.month = w.month),
combined AS (
  SELECT {MONTHLY_COLUMNS} FROM (
    SELECT *, CASE WHEN cumulative_base > 0
      THEN CAST(ending_count AS DOUBLE) / CAST(cumulative_base AS DOUBLE) ELSE 0.0 END AS take_rate
    FROM (SELECT *, CAST(sum(base) OVER (PARTITION BY tier ORDER BY month) AS BIGINT)
            AS cumulative_base FROM joined)))"""


_ROW = """account_number, package_group, wo_type_group, reason_group,
  CAST(start_date AS VARCHAR) AS start_date, coalesce(CAST(end_date AS VARCHAR), '') AS end_date,
  CAST(price AS DOUBLE) AS price, CAST(test_flag AS BIGINT) AS test_flag,
  CAST(cxn_code AS BIGINT) AS cxn_code, site, order_key, CAST(line_number AS BIGINT) AS line_number,
  part_key"""
_KEYED = f"{_ROW}, week_key, month_key, quarter_key, year_key"
_TAGGED = f"""{_KEYED}, CAST(churn_flag AS BIGINT) AS churn_flag,
  coalesce(CAST(churn_date AS VARCHAR), '') AS churn_date, revenue_category"""

RAW = f"""
raw AS (
  SELECT * REPLACE (
      CASE WHEN line_number = 1 THEN NULL ELSE package_group END AS package_group,
      CASE WHEN line_number = 1 THEN NULL ELSE reason_group END AS reason_group,
      CASE WHEN line_number = 1 THEN NULL ELSE test_flag END AS test_flag,
      CASE WHEN line_number = 1 THEN NULL ELSE cxn_code END AS cxn_code,
      CASE line_number WHEN 2 THEN '(5)' WHEN 3 THEN '-' WHEN 4 THEN concat('$1,', price)
        ELSE concat('$', price, ' ') END AS price)
  FROM (SELECT {CONTRACT_COLUMNS.replace('as string', 'as varchar')},
          CASE WHEN l_linenumber = 1 THEN NULL ELSE l_discount END AS discount,
          CASE WHEN l_quantity > 20 THEN NULL ELSE l_tax END AS tax {_STAR}))"""
_PRICE = "coalesce(TRY_CAST(trim(replace(replace(price, '$', ''), ',', '')) AS DECIMAL(18,2)), 0)"
_RAW_COLUMNS = {
    "account_number": "string", "package_group": "string", "wo_type_group": "string",
    "reason_group": "string", "start_date": "date", "end_date": "date", "price": "string",
    "test_flag": "int", "cxn_code": "int", "site": "string", "order_key": "bigint",
    "line_number": "int", "part_key": "bigint", "discount": "double", "tax": "double",
}


def _profile() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count,"
        f" (count(*) - count({c})) * 100.0::DOUBLE / count(*) AS missing_percentage,"
        f" '{t}' AS data_type FROM raw"
        for c, t in _RAW_COLUMNS.items()
    )


def _median(column: str) -> str:
    return f"(SELECT median({column}) FROM raw)"


def _cleaned() -> str:
    """Raw rows after all fills; ids keep their gaps, the sparse column is gone."""
    return f"""SELECT account_number, coalesce(package_group, 'Unknown') AS package_group,
      wo_type_group, coalesce(reason_group, 'Unknown') AS reason_group,
      CAST(start_date AS VARCHAR) AS start_date,
      coalesce(CAST(end_date AS VARCHAR), '') AS end_date, CAST({_PRICE} AS DOUBLE) AS price,
      CAST(coalesce(test_flag, -1) AS BIGINT) AS test_flag,
      CAST(coalesce(cxn_code, -1) AS BIGINT) AS cxn_code, site, order_key,
      CAST(line_number AS BIGINT) AS line_number, part_key,
      coalesce(discount, {_median('discount')}) AS discount
    FROM raw"""


def cleaned_head() -> str:
    """Cleaned raw rows in the place of ``contracts``."""
    return f"""{RAW},
contracts AS (
  SELECT * REPLACE (coalesce(package_group, 'Unknown') AS package_group,
    coalesce(reason_group, 'Unknown') AS reason_group,
    CAST({_PRICE} AS DECIMAL(18,2)) AS price) FROM raw)"""


def _quantile(p: float) -> str:
    """Linear interpolation, spelled out: the built-in rounds its blend differently."""
    low = f"max(v) FILTER (rk = floor({p} * top))"
    high = f"max(v) FILTER (rk = ceil({p} * top))"
    return f"{low} + ({high} - {low}) * max(CAST({p} AS DOUBLE) * top - floor({p} * top))"


def oracle_sql() -> dict[str, str]:
    early = EARLY_AS_OF
    base_run = f"WITH {prep()},{tiered()},{start_new()}"
    sql = {
        "contracts": f"WITH {CONTRACTS} SELECT {_ROW} FROM contracts",
        "missing_profile": f"WITH {RAW} {_profile()}",
        "currency_parse": f"WITH {RAW} SELECT price AS price_text,"
        f" CAST({_PRICE} AS DOUBLE) AS price, count(*) AS n FROM raw GROUP BY ALL",
        "currency_format": "SELECT o_orderkey AS order_key, coalesce(CASE WHEN o_totalprice < 0"
        " THEN concat('$-', format('{:,.2f}', -o_totalprice))"
        " ELSE concat('$', format('{:,.2f}', o_totalprice)) END, 'N/A') AS total FROM orders",
        "drop_sparse_columns": f"WITH {RAW} SELECT column_name, count(*) AS n_columns FROM"
        f" ({_profile()}) WHERE missing_percentage <= 50 GROUP BY ALL",
        "fill_unknown": f"WITH {RAW} SELECT coalesce(package_group, 'Unknown') AS package_group,"
        " wo_type_group, coalesce(reason_group, 'Unknown') AS reason_group, count(*) AS n"
        " FROM raw GROUP BY ALL",
        "fill_median": f"WITH {RAW} SELECT order_key, CAST(line_number AS BIGINT) AS line_number,"
        f" part_key, CAST(coalesce(test_flag, {_median('test_flag')}) AS DOUBLE) AS test_flag,"
        f" CAST(coalesce(cxn_code, {_median('cxn_code')}) AS DOUBLE) AS cxn_code,"
        f" coalesce(discount, {_median('discount')}) AS discount,"
        f" coalesce(tax, {_median('tax')}) AS tax FROM raw",
        "medians": f"WITH {RAW} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(median({c}) AS DOUBLE) AS median FROM raw"
            for c in ("test_flag", "cxn_code", "discount", "tax", "order_key", "part_key")
        ),
        "cleaned_contracts": f"WITH {RAW} {_cleaned()}",
        "prepared_from_raw": f"WITH {prep(head=cleaned_head())} SELECT {_TAGGED} FROM deduped",
        "csv_round_trip": f"WITH {CONTRACTS} SELECT {_ROW} FROM opened",
        "wide_sites": f"WITH {SITES} SELECT site, month, CAST(cxn_code AS BIGINT) AS cxn_code,"
        " base FROM site_rows",
        "business_filter": f"WITH {CONTRACTS} SELECT {_ROW} FROM business",
        "time_keys": f"WITH {CONTRACTS} SELECT {_KEYED} FROM business",
        "churn_accounts": f"""WITH {prep()}
            SELECT account_number, count(*) AS n_rows, CAST(max(churn_flag) AS BIGINT) AS churn_flag,
              coalesce(CAST(max(churn_date) AS VARCHAR), '') AS churn_date
            FROM flagged GROUP BY account_number""",
        "churn_summary": f"""WITH {prep()}
            SELECT CAST(churn_flag AS BIGINT) AS churn_flag, count(*) AS n_rows,
              count(DISTINCT account_number) AS accounts,
              coalesce(CAST(min(churn_date) AS VARCHAR), '') AS first_churn,
              coalesce(CAST(max(churn_date) AS VARCHAR), '') AS last_churn
            FROM flagged GROUP BY ALL""",
        "churned_without_date": f"""WITH {prep()}
            SELECT {_KEYED}, CAST(churn_flag AS BIGINT) AS churn_flag,
              coalesce(CAST(churn_date AS VARCHAR), '') AS churn_date
            FROM flagged WHERE churn_flag = 1 AND churn_date IS NULL""",
        "revenue_category": f"WITH {prep()} SELECT {_TAGGED} FROM tagged",
        "dedupe_category": f"WITH {prep()} SELECT {_TAGGED} FROM step1",
        "dedupe_overlap": f"""WITH {prep()} SELECT {_TAGGED} FROM tagged
            QUALIFY row_number() OVER (
              PARTITION BY account_number, package_group, start_date
              ORDER BY end_date DESC NULLS LAST, price, wo_type_group, reason_group, cxn_code, site,
                order_key, line_number, part_key) = 1""",
        "deduped_contracts": f"WITH {prep()} SELECT {_TAGGED} FROM deduped",
        "exclusivity_check": f"""WITH {prep()},
            per_key AS (
              SELECT account_number, start_date, package_group,
                count(DISTINCT revenue_category) AS n_categories
              FROM tagged GROUP BY ALL HAVING count(DISTINCT revenue_category) > 1)
            SELECT {_TAGGED}, n_categories
            FROM tagged JOIN per_key USING (account_number, start_date, package_group)""",
        "tier_rows": f"WITH {prep()},{tiered()} SELECT tier, {_TAGGED} FROM tiered",
        "tier_filter": f"WITH {prep()},{BRIDGE} SELECT {_TAGGED} FROM deduped SEMI JOIN"
        " (SELECT cxn_code FROM bridge WHERE tier = 'moderate_performers') USING (cxn_code)",
        "tier_month_counts": f"""WITH {prep()},{tiered()}
            SELECT tier, month_key AS month, count(*) AS contracts,
              count(DISTINCT account_number) AS accounts FROM tiered GROUP BY ALL""",
        "reprice_new": f"WITH {splits()} SELECT {_TAGGED} FROM repriced",
        "split_contracts": f"WITH {splits()} SELECT {_TAGGED} FROM split",
        "tail": f"""WITH {combined()} SELECT tier, month, ending_mrr, starting_count FROM combined
            QUALIFY row_number() OVER (PARTITION BY tier ORDER BY month DESC) <= 5""",
        "split_contracts_long_list": f"WITH RECURSIVE {long_splits()} SELECT {_TAGGED} FROM split",
        "split_contracts_by_table": f"WITH {splits()} SELECT {_TAGGED} FROM split",
        "price_change_impact": _impact(),
        "price_change_impact_of_table": _impact(),
        "split_summary": f"""WITH {splits()}
            SELECT count(DISTINCT c.rid) AS contracts_cut,
              CAST(count(*) + count(DISTINCT c.rid) AS BIGINT) AS periods_created,
              (SELECT count(*) FROM split) AS contracts_after FROM cuts c""",
        "calendar_spine": f"{base_run} SELECT tier, strftime(m0, '%Y-%m') AS month FROM spine",
        "mrr_start_new": f"{base_run} SELECT * FROM start_new",
        "mrr_start_new_explode": f"{base_run} SELECT * FROM start_new",
        "mrr_start_new_early": f"WITH {prep(early)},{tiered()},{start_new(early)}"
        " SELECT * FROM start_new",
        "active_accounts": f"""WITH {prep()},{tiered()},
            months AS (
              SELECT tier, CAST(m AS DATE) AS m0, last_day(CAST(m AS DATE)) AS m1
              FROM (SELECT tier, unnest(generate_series(date_trunc('month', min(start_date)),
                      date_trunc('month', max(end_date)), INTERVAL '1' MONTH)) AS m
                    FROM tiered GROUP BY tier))
            SELECT m.tier, strftime(m.m0, '%Y-%m') AS month,
              count(DISTINCT t.account_number) AS active_accounts
            FROM months m LEFT JOIN tiered t ON t.tier = m.tier AND t.start_date <= m.m1
              AND (t.end_date >= m.m0 OR t.end_date IS NULL)
            GROUP BY ALL""",
        "expansion": f"WITH {prep()},{tiered()},{EXPANSION} SELECT * FROM expansion",
        "contraction": f"WITH {prep()},{tiered()},{CONTRACTION} SELECT * FROM contraction",
        "price_moves": f"""WITH {prep()},{tiered()},{EXPANSION},{CONTRACTION}
            SELECT tier, month, expansion, coalesce(expansion_count, 0) AS expansion_count,
              contraction, coalesce(contraction_count, 0) AS contraction_count
            FROM expansion FULL JOIN contraction USING (tier, month)""",
        "churn_revenue": f"WITH {prep()},{tiered()},{CHURN} SELECT * FROM churn",
        "mrr_waterfall": f"WITH {waterfall()} SELECT * EXCLUDE (tier) FROM waterfall"
        " WHERE tier = 'Full'",
        "mrr_waterfall_by_tier": f"WITH {waterfall()} SELECT * FROM waterfall",
        "mrr_waterfall_early": f"WITH {waterfall(early)} SELECT * FROM waterfall",
        "mrr_waterfall_repriced": f"WITH {waterfall(rows=splits(), source='split')}"
        " SELECT * FROM waterfall",
        "arr": f"WITH {waterfall()} SELECT tier, month, ending_mrr * 12 AS arr FROM waterfall"
        " QUALIFY row_number() OVER (PARTITION BY tier ORDER BY month DESC) = 2",
        "parpu": f"WITH {waterfall()} SELECT tier, month, {PARPU} FROM waterfall",
        "combined_metrics": f"WITH {combined()} SELECT {MONTHLY_COLUMNS} FROM combined",
        "combined_metrics_repriced": f"WITH {combined(rows=splits(), source='split')}"
        f" SELECT {MONTHLY_COLUMNS} FROM combined",
        "cumulative_arpu": f"""WITH {prep()},{tiered()}
            SELECT tier, account_number,
              CAST(sum(CAST(price * 100 AS BIGINT)) AS DOUBLE) / 100.0 AS cumulative_arpu
            FROM tiered GROUP BY ALL""",
        "cumulative_arpu_summary": f"""WITH {prep()},{tiered()},
            per_account AS (
              SELECT tier, account_number, sum(CAST(price * 100 AS BIGINT)) AS cents,
                CAST(sum(CAST(price * 100 AS BIGINT)) AS DOUBLE) / 100.0 AS v
              FROM tiered GROUP BY ALL)
            SELECT tier, count(*) AS total_customers,
              CAST(sum(cents) AS DOUBLE) / CAST(count(*) * 100 AS DOUBLE)
                AS average_cumulative_arpu,
              CAST(sum(cents) AS DOUBLE) / 100.0 AS total_revenue, max(v) AS max_customer_value,
              min(v) AS min_customer_value, {_quantile(0.5)} AS median_cumulative_arpu,
              {_quantile(0.9)} AS top_10_percent_arpu
            FROM (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY v) - 1 AS rk,
                    count(*) OVER (PARTITION BY tier) - 1 AS top FROM per_account)
            GROUP BY ALL""",
        "site_opens": f"WITH {prep()},{tiered()},{SITES},{SITE_METRICS} SELECT * FROM opens",
        "base_added": f"WITH {prep()},{tiered()},{SITES},{SITE_METRICS} SELECT * FROM bases",
        "take_rate": f"WITH {combined()} SELECT tier, month, base, cumulative_base, take_rate"
        " FROM combined",
    }
    for key in ("week", "month", "quarter", "year"):
        sql[f"arpu_{key}"] = f"WITH {prep()},{tiered()},{arpu(f'{key}_key')} SELECT * FROM arpu"
    return sql


def _impact() -> str:
    """Prices before each change come from a chain of conditionals, one more per change."""
    price, parts = "price", []
    for i, c in enumerate(CHANGES, 1):
        package = f"package_group = '{c.package}'"
        date = f"start_date >= DATE '{c.effective_date}'"
        match = f"{price} = {c.old_price}"
        parts.append(
            f"SELECT CAST({i} AS BIGINT) AS seq, '{c.package}' AS package,"
            f" '{c.effective_date}' AS effective_date, CAST({c.old_price} AS DOUBLE) AS old_price,"
            f" CAST({c.new_price} AS DOUBLE) AS new_price,"
            f" count(*) FILTER ({package}) AS package_matches,"
            f" count(*) FILTER ({date}) AS date_matches,"
            f" count(*) FILTER ({match}) AS price_matches,"
            f" count(*) FILTER ({package} AND {date} AND {match}) AS contracts_repriced,"
            f" (SELECT count(*) FROM repriced r WHERE r.package_group = '{c.package}'"
            f" AND r.price = {c.old_price} AND r.start_date < DATE '{c.effective_date}'"
            f" AND DATE '{c.effective_date}' < r.end_date) AS contracts_cut FROM deduped"
        )
        price = (
            f"(CASE WHEN {package} AND {date} AND {match}"
            f" THEN CAST({c.new_price} AS DECIMAL(18,2)) ELSE {price} END)"
        )
    return f"WITH {splits()} " + " UNION ALL ".join(parts)
