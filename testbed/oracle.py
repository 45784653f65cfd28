"""An independent statement of every registered query in DuckDB SQL.

Each query is a final SELECT over named building blocks; ``compose`` adds the
blocks it depends on as common table expressions.  Money leaves as DOUBLE, dates
and instants as TIMESTAMP, small integers as INTEGER.
"""

from __future__ import annotations

import re

from testbed.ledger import AS_OF, CATALOG, PAY_RATES, PRODUCTS


def _values(rows: list[tuple]) -> str:
    def literal(value: object) -> str:
        return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)


_PRODUCT = "CASE c_mktsegment " + " ".join(
    f"WHEN '{segment}' THEN '{name}'" for segment, name in PRODUCTS.items()
) + " END"


def _has(column: str, word: str) -> str:
    return f"contains(lower({column}), '{word}')"


def _since_months_ago(column: str, months: int = 6) -> str:
    """The trailing-months rule, stated on the row's month."""
    month = f"date_trunc('month', {column})"
    return (
        f"{month} >= date_trunc('month', DATE '{AS_OF}') - INTERVAL {months} MONTH"
        f" AND {month} <= DATE '{AS_OF}'"
    )


def _pct(name: str) -> str:
    """Relative change of a measure against the month before."""
    return (
        f"CASE WHEN last_{name} = 0 THEN NULL ELSE TRY_CAST(round("
        f"({name} - last_{name})::DOUBLE / abs(last_{name})::DOUBLE, 2)"
        f" AS DECIMAL(14,4))::DOUBLE END"
    )


def _delta(name: str) -> str:
    return f"TRY_CAST(round({name} - last_{name}, 2) AS DECIMAL(12,2))::DOUBLE"


_COLORS = ("green", "red", "grey", "black")
_PERIODS = {
    "day": "1 DAY",
    "week": "7 DAY",
    "month": "1 MONTH",
    "quarter": "3 MONTH",
    "year": "1 YEAR",
}

BLOCKS: dict[str, str] = {
    "ledger": f"""
        SELECT o_custkey::VARCHAR AS account_id,
               {_PRODUCT} || ' ' || c_name AS account_name,
               l_orderkey || '-' || l_linenumber || suffix AS txn_id,
               CASE WHEN o_orderpriority = '1-URGENT' THEN
                      CASE o_orderstatus WHEN 'F' THEN 'Transfer to credit card '
                                         WHEN 'O' THEN 'Transfer to mortgage '
                                         ELSE 'Transfer to savings ' END
                    WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'
                      THEN 'Interest charge on '
                    ELSE '' END || p_type || ' ' || p_name AS description,
               nullif(p_brand, 'Brand#25') AS payee,
               (CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END
                 * floor(l_extendedprice)::DECIMAL(14,0) * 0.01)::DECIMAL(14,2) AS amount,
               l_shipdate AS posted,
               l_partkey || '/' || l_suppkey AS filename
        FROM (SELECT *, unnest(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F'
                                    THEN ['', '-again'] ELSE [''] END) AS suffix
              FROM lineitem)
        JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey
        JOIN part ON p_partkey = l_partkey""",
    "fact": """
        SELECT * EXCLUDE (r),
               md5(coalesce(lower(payee), 'NULL') || '||'
                   || coalesce(lower(description), 'NULL')) AS merchant
        FROM (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY posted DESC,
                filename DESC, account_id DESC, account_name DESC, description DESC,
                payee DESC NULLS LAST, amount DESC) AS r
              FROM ledger)
        WHERE r = 1""",
    "catalog": f"""
        SELECT * FROM (VALUES {_values(CATALOG)})
          AS c(category, subcategory, pattern, priority)""",
    "rates": f"""
        SELECT employer, pay::DECIMAL(12,2) AS pay, d1::DATE AS d1, d2::DATE AS d2
        FROM (VALUES {_values(PAY_RATES)}) AS r(employer, address, pay, d1, d2)""",
    "merchant": """
        SELECT g.*, coalesce(best.category, '**UNKNOWN**') AS category,
               coalesce(best.subcategory, '**UNKNOWN**') AS subcategory
        FROM (SELECT merchant, any_value(lower(payee)) AS name,
                     any_value(lower(description)) AS description,
                     min(posted) AS first_at, max(posted) AS last_at,
                     count(DISTINCT txn_id) AS txns, sum(amount) AS total, """
    + ", ".join(
        f"coalesce(sum(amount) FILTER (WHERE posted >= (SELECT max(posted) FROM fact)"
        f" - INTERVAL {length}), 0)::DECIMAL(38,2) AS past_{name}"
        for name, length in _PERIODS.items()
    )
    + """
              FROM fact GROUP BY merchant) g
        LEFT JOIN LATERAL (
              SELECT category, subcategory FROM catalog
              WHERE regexp_matches(g.description, pattern)
              ORDER BY priority, category, subcategory, pattern LIMIT 1) best ON true""",
    "days": """
        SELECT d::DATE AS d FROM (
          SELECT unnest(generate_series(min(posted)::DATE, max(posted)::DATE,
                                        INTERVAL 1 DAY)) AS d FROM fact)""",
    "pay": f"""
        SELECT d, quarter(d) AS q, employer,
               TRY_CAST((pay * 2)::DOUBLE / day(last_day(d)) AS DECIMAL(12,2)) AS income
        FROM days LEFT JOIN rates ON d >= d1 AND d <= d2
        WHERE d <= DATE '{AS_OF}'""",
    "one_each": """
        SELECT account_id, description, payee, posted, amount, merchant,
               arg_min(account_name, (filename, txn_id)) AS account_name
        FROM fact GROUP BY ALL""",
    "expenses": f"""
        SELECT posted, category, subcategory, payee, description, account_name,
               (-amount)::DECIMAL(18,2) AS spent
        FROM one_each JOIN (SELECT merchant, category, subcategory FROM merchant
                            WHERE total < 0) USING (merchant)
        WHERE NOT {_has("description", "transfer")}
           OR {_has("description", "credit card")} OR {_has("description", "mortgage")}""",
    "income": f"""
        SELECT posted, category, subcategory, payee, description, account_name, amount
        FROM one_each JOIN (SELECT merchant, category, subcategory FROM merchant
                            WHERE NOT {_has("category", "transfer")}) USING (merchant)
        WHERE amount >= 0""",
    "unknown": f"""
        SELECT amount, posted, payee, description, category
        FROM one_each JOIN (SELECT merchant, category FROM merchant) USING (merchant)
        WHERE {_has("category", "unkn")}""",
    "overunder": """
        SELECT d, coalesce(income, 0)::DECIMAL(12,2) AS income,
               coalesce(spend, 0)::DECIMAL(12,2) AS spend,
               greatest(coalesce(income - spend, 0), 0)::DECIMAL(12,2) AS over,
               least(coalesce(income - spend, 0), 0)::DECIMAL(12,2) AS under,
               CASE WHEN spend IS NULL OR spend = 0 THEN 'Green'
                    WHEN income IS NULL THEN NULL
                    WHEN income = spend THEN 'Black'
                    WHEN abs(income - spend) <= 25 THEN 'Grey'
                    WHEN income > spend THEN 'Green' ELSE 'Red' END AS color
        FROM pay LEFT JOIN (SELECT posted::DATE AS d, sum(spent) AS spend
                            FROM expenses GROUP BY 1) USING (d)""",
    "savings": """
        SELECT m, spend, earned, earned - spend AS kept,
               CASE WHEN earned > 0 THEN
                 ((earned - spend)::DOUBLE / earned::DOUBLE)::DECIMAL(36,4)
               ELSE 0 END AS fraction
        FROM (SELECT date_trunc('month', posted)::DATE AS m, sum(spent) AS spend
              FROM expenses GROUP BY 1)
        JOIN (SELECT date_trunc('month', posted)::DATE AS m, sum(amount) AS earned
              FROM income GROUP BY 1) USING (m)""",
    "mom": f"""
        SELECT *, {", ".join(f"lag({n}) OVER (ORDER BY y, mth) AS last_{n}"
                             for n in ("balance", "spend", *_COLORS))}
        FROM (SELECT year(posted) AS y, month(posted) AS mth, sum(amount) AS balance
              FROM fact WHERE day(posted) <= {int(AS_OF[-2:])}
               AND (NOT {_has("description", "transfer")}
                    OR {_has("description", "mortgage")}
                    OR {_has("description", "cashreward")})
              GROUP BY ALL)
        LEFT JOIN (SELECT year(d) AS y, month(d) AS mth, avg(spend) AS spend,
                   {", ".join(f"count(*) FILTER (WHERE color = '{c.title()}') AS {c}"
                              for c in _COLORS)}
                   FROM overunder WHERE day(d) <= {int(AS_OF[-2:])} GROUP BY ALL)
          USING (y, mth)""",
    "offered": f"""
        SELECT o_orderkey::VARCHAR AS id, n AS name, b AS bal,
               CASE WHEN o_orderstatus <> 'P' THEN b END AS avail, o_orderdate AS moment
        FROM (SELECT *, {_PRODUCT} || ' ' || c_name AS n, o_totalprice::DECIMAL(14,2) AS b
              FROM orders JOIN customer ON c_custkey = o_custkey
              UNION ALL
              SELECT *, 'Reserve ' || c_name, c_acctbal::DECIMAL(14,2)
              FROM orders JOIN customer ON c_custkey = o_custkey)""",
    "accounts": f"""
        SELECT id, name, bal, avail, moment, filename FROM (
          SELECT o_orderkey::VARCHAR AS id, n AS name, b AS bal,
                 CASE WHEN o_orderstatus <> 'P' THEN b END AS avail,
                 o_orderdate AS moment, 'order-' || o_orderkey AS filename,
                 row_number() OVER (PARTITION BY n
                   ORDER BY o_orderdate DESC, 'order-' || o_orderkey DESC) AS r
          FROM (SELECT *, {_PRODUCT} || ' ' || c_name AS n,
                       o_totalprice::DECIMAL(14,2) AS b
                FROM orders JOIN customer ON c_custkey = o_custkey
                UNION ALL
                SELECT *, 'Reserve ' || c_name, c_acctbal::DECIMAL(14,2)
                FROM orders JOIN customer ON c_custkey = o_custkey))
        WHERE r = 1""",
    "listing": """
        SELECT posted::DATE AS d, spent, payee, category, subcategory, description,
               account_name
        FROM expenses WHERE NOT contains(category || subcategory, 'kratom')""",
    "as_of_days": """
        SELECT (DATE '2001-06-15' - 60 * i::INTEGER) AS moment
        FROM (SELECT unnest(range(0, 40)) AS i)
        WHERE moment >= DATE '1995-01-01'""",
    "recent_income": f"""
        SELECT posted::DATE AS d, amount, description,
               category || ' | ' || subcategory AS kind
        FROM income WHERE {_since_months_ago("posted")}""",
}

def compose(select: str) -> str:
    """The SELECT with the blocks it names, directly or through others."""
    order: list[str] = []

    def need(text: str) -> None:
        for name, body in BLOCKS.items():
            if name not in order and re.search(rf"(?:FROM|JOIN) {name}\b", text):
                need(body)
                if name not in order:
                    order.append(name)

    need(select)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({BLOCKS[name]})" for name in order)
    return f"WITH {ctes}\n{select}" if ctes else select


_LISTING = """d::TIMESTAMP AS posted_date, spent::DOUBLE AS amount_spent,
    payee AS merchant, category, subcategory, description, account_name AS account"""

_SAVINGS = """m::TIMESTAMP AS year_month, spend::DOUBLE AS total_spend,
    earned::DOUBLE AS total_earned, greatest(kept, 0)::DOUBLE AS dollars_saved,
    least(kept, 0)::DOUBLE AS dollars_lost"""

_RECENT_SPEND = f"""posted::DATE::TIMESTAMP AS posted_date, spent::DOUBLE AS amount_spent,
    description, account_name AS account"""

_MOM_COLUMNS = ",\n".join(
    [
        f"DATE '{AS_OF}'::TIMESTAMP AS as_of_date",
        "TRY_CAST(mth AS UTINYINT)::INTEGER AS month",
        "TRY_CAST(balance AS DECIMAL(12,2))::DOUBLE AS current_monthly_balance",
        "TRY_CAST(last_balance AS DECIMAL(12,2))::DOUBLE AS this_time_last_month_balance",
        f"{_delta('balance')} AS dollars_mom_balance_delta",
        f"{_pct('balance')} AS pcnt_mom_balance_delta",
        "TRY_CAST(round(spend) AS DECIMAL(12,2))::DOUBLE AS avg_daily_spend",
        "TRY_CAST(round(last_spend) AS DECIMAL(12,2))::DOUBLE AS last_month_avg_daily_spend",
        f"{_delta('spend')} AS dollars_mom_avg_daily_spend_delta",
        f"{_pct('spend')} AS pcnt_mom_avg_daily_spend_delta",
        *[
            f"TRY_CAST({c} AS UTINYINT)::INTEGER AS total_{c}_days,"
            f" TRY_CAST(last_{c} AS UTINYINT)::INTEGER AS last_month_total_{c}_days,"
            f" {_delta(c)} AS mom_total_{c}_days_change,"
            f" {_pct(c)} AS pcnt_mom_total_{c}_days"
            for c in _COLORS
        ],
    ]
)


def _balance(where: str) -> str:
    return f"SELECT sum(bal)::DOUBLE AS balance FROM accounts WHERE {where}"


def _dates(year: str) -> str:
    return f"""SELECT d::TIMESTAMP AS full_date, {year}::INTEGER AS date_year,
        quarter(d)::INTEGER AS date_quarter, month(d)::INTEGER AS date_month,
        monthname(d) AS name_date_month,
        days_in_month(d)::INTEGER AS total_days_in_month,
        week(d)::INTEGER AS date_week, isodow(d)::INTEGER AS day_of_week,
        dayname(d) AS name_day_of_week, isodow(d) > 5 AS is_weekend_ind FROM days"""


def _top(average: str) -> str:
    return f"""SELECT name AS merchant_name, category, subcategory,
        (-total)::DOUBLE AS total_spend,
        {", ".join(f"(-past_{p})::DOUBLE AS past_{p}" for p in _PERIODS)},
        first_at AS earliest_txn_at, last_at AS latest_txn_at,
        txns AS total_transactions,
        TRY_CAST(round({average}, 2) AS DECIMAL(38,2))::DOUBLE AS avg_spend_per_txn
        FROM merchant WHERE total < 0 AND category <> 'transfers'"""


_FACT = """SELECT account_id AS bank_account_id, account_name AS bank_account_name,
    txn_id, description AS txn_description, merchant AS merchant_category_key, payee,
    amount::DOUBLE AS amount, posted AS posted_at_timestamp, filename FROM fact"""


def _judged_days(cut_every: int) -> str:
    return f"""
        WITH f AS (SELECT o_orderdate::DATE AS day,
                          (o_orderdate::DATE - DATE '1970-01-01') % {cut_every} = 0 AS cut,
                          (2 * count(*))::INTEGER AS n
                   FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY o_orderdate::DATE),
             s AS (SELECT 'nothing' AS stored, NULL::DATE AS newest, false AS taken
                   UNION ALL SELECT 'before', max(day), false FROM f WHERE NOT cut AND day < DATE '{AS_OF}'
                   UNION ALL SELECT 'all', max(day), coalesce(bool_or(day = DATE '{AS_OF}'), false)
                             FROM f WHERE NOT cut
                   UNION ALL SELECT 'today', DATE '{AS_OF}', true)
        SELECT stored, strftime(day, '%Y-%m-%d') AS filename,
               CASE WHEN cut THEN 0 ELSE n END AS n_accounts,
               CASE WHEN taken THEN 'captured_today' WHEN cut THEN 'empty'
                    WHEN day <= newest THEN 'not_newer' ELSE 'new' END AS decision
        FROM f CROSS JOIN s"""


_MISSING = "NOT EXISTS (SELECT 1 FROM {parent} WHERE {key} = {value})"

SELECTS: dict[str, str] = {
    # Star schema
    "fact_dedup": _FACT,
    "fact_from_snapshots": _FACT,
    "accounts_latest": """SELECT id AS bank_account_id, name AS bank_account_name,
        'USD' AS currency, bal::DOUBLE AS actual_balance,
        avail::DOUBLE AS available_balance, moment AS balance_as_of_timestamp, filename
        FROM accounts""",
    "dim_merchant": f"""SELECT merchant AS merchant_category_key, name AS merchant_name,
        category AS merchant_category, subcategory AS merchant_subcategory,
        first_at AS earliest_txn_at, last_at AS latest_txn_at,
        txns AS total_transactions, total::DOUBLE AS total_amount,
        {", ".join(f"past_{p}::DOUBLE AS amount_past_{p}" for p in _PERIODS)}
        FROM merchant""",
    "dim_date": _dates("TRY_CAST(year(d) AS UTINYINT)"),
    "dim_date_corrected": _dates("year(d)"),
    "daily_pay": """SELECT d::TIMESTAMP AS calendar_date,
        q::INTEGER AS calendar_quarter, income::DOUBLE AS daily_income,
        employer AS from_employer FROM pay""",
    # Marts
    "expenses_detail": """SELECT posted AS posted_at_timestamp,
        category AS merchant_category, subcategory AS merchant_subcategory,
        payee AS merchant, description AS txn_description, account_name AS account,
        spent::DOUBLE AS amount_spent FROM expenses""",
    "income_detail": """SELECT posted AS posted_at_timestamp,
        category AS merchant_category, subcategory AS merchant_subcategory,
        payee AS merchant, description AS txn_description, account_name AS account,
        amount::DOUBLE AS amount_earned FROM income""",
    "unknown_transactions": """SELECT amount::DOUBLE AS amount,
        posted AS posted_at_timestamp, payee, description AS txn_description,
        category AS merchant_category FROM unknown""",
    "daily_overunder": """SELECT d::TIMESTAMP AS calendar_date,
        income::DOUBLE AS daily_income, spend::DOUBLE AS daily_spend,
        over::DOUBLE AS dollars_over, under::DOUBLE AS dollars_under,
        color AS day_color FROM overunder""",
    "monthly_savings": f"""SELECT {_SAVINGS}, fraction::DOUBLE AS pcnt_saved,
        fraction::DOUBLE AS pcnt_lost FROM savings""",
    "monthly_savings_corrected": f"""SELECT {_SAVINGS},
        (CASE WHEN kept > 0 THEN fraction ELSE 0 END)::DOUBLE AS pcnt_saved,
        (CASE WHEN kept > 0 THEN 0 ELSE fraction END)::DOUBLE AS pcnt_lost
        FROM savings""",
    "mom_performance": f"""SELECT TRY_CAST(y AS UTINYINT)::INTEGER AS year,
        {_MOM_COLUMNS} FROM mom""",
    "mom_performance_corrected": f"""SELECT y::INTEGER AS year, {_MOM_COLUMNS} FROM mom""",
    "top_expenses": _top("-(txns::DOUBLE / total::DOUBLE)"),
    "top_expenses_ranked": _top("-(txns::DOUBLE / total::DOUBLE)")
    + " ORDER BY total_spend DESC",
    "top_expenses_corrected": _top(
        # Whole cents, halves up: (2c + n) div 2n.
        "((2 * (-total * 100)::HUGEINT + txns) // (2 * txns))::DECIMAL(38,0) / 100"
    ),
    # Report queries
    "q01_total_assets_minus_mortgage": _balance("NOT " + _has("name", "mortgage")),
    "q02_total_cc_debt": _balance(_has("name", "cashrewards")),
    "q03_total_checking": _balance(_has("name", "check")),
    "q04_total_mortgage": _balance(_has("name", "mortgage")),
    "q05_total_savings1": _balance(_has("name", "market savings")),
    "q06_total_savings2": _balance(_has("name", "share savings")),
    "q07_chart_coe_expenses_detail": f"""SELECT
        left(posted::VARCHAR, 7) AS year_month, subcategory,
        sum(spent)::DOUBLE AS amount_spent FROM expenses
        WHERE spent < 500 AND category = 'cost-of-living'
          AND {_since_months_ago("posted")} GROUP BY ALL""",
    "q08_chart_daily_overunder": """SELECT d::TIMESTAMP AS calendar_date,
        income::DOUBLE AS daily_income, spend::DOUBLE AS daily_spend,
        over::DOUBLE AS dollars_over, under::DOUBLE AS dollars_under,
        color AS day_color FROM overunder
        WHERE d >= (SELECT min(posted)::DATE FROM expenses)""",
    "q09_chart_monthly_savings": """SELECT strftime(m, '%Y|%m') AS year_month,
        spend::DOUBLE AS total_spend, earned::DOUBLE AS total_earned,
        (spend + earned)::DOUBLE AS account_balance,
        greatest(kept, 0)::DOUBLE AS dollars_saved, fraction::DOUBLE AS pcnt_saved,
        least(kept, 0)::DOUBLE AS dollars_lost, fraction::DOUBLE AS pcnt_lost
        FROM savings""",
    "q10_rows_all_expenses": f"SELECT {_LISTING} FROM listing",
    "q11_rows_cc_interest_payments": f"""SELECT {_RECENT_SPEND}, payee AS merchant,
        category, subcategory FROM expenses WHERE {_has("account_name", "cashreward")}
        AND {_has("description", "interest")} AND {_since_months_ago("posted")}""",
    "q12_rows_income": """SELECT d::TIMESTAMP AS posted_date,
        amount::DOUBLE AS amount_earned, description AS income_source,
        kind AS income_type FROM recent_income""",
    "q13_rows_mortgage_payment": f"""SELECT {_RECENT_SPEND} FROM expenses
        WHERE {_has("description", "mortgage")} AND {_since_months_ago("posted")}""",
    "q14_rows_monthly_savings": f"""SELECT {_SAVINGS}, fraction::DOUBLE AS pcnt_saved,
        fraction::DOUBLE AS pcnt_lost FROM savings""",
    "q15_rows_cc_spend": f"""SELECT {_LISTING} FROM listing
        WHERE {_has("account_name", "cashreward")}""",
    "q16_col_dollar_bounds": """SELECT min(spent)::DOUBLE AS least_spent,
        max(spent)::DOUBLE AS most_spent FROM listing""",
    "q17_flt_chart_col_expenses": """SELECT category, subcategory,
        sum(spent)::DOUBLE AS total_spend FROM listing
        WHERE spent <= 600.5 AND category IN ('cost-of-living', 'debt', 'payments')
          AND d >= DATE '1996-02-29' GROUP BY ALL""",
    "q18_unique_merch_cats": "SELECT DISTINCT category FROM listing",
    "q19_expenses_detail_bounds": """SELECT min(posted) AS start_date,
        date_diff('day', min(posted), max(posted)) AS date_span FROM expenses""",
    "q20_flt_rows_all_expenses": f"""SELECT {_LISTING} FROM listing
        WHERE d BETWEEN DATE '1997-01-15' AND DATE '1999-12-31'
          AND category IN ('going-out', 'debt')""",
    "q21_savings_bounds": """SELECT min(m)::TIMESTAMP AS start_month,
        date_diff('month', min(m), max(m)) AS month_span FROM savings""",
    "q22_total_saved": "SELECT sum(greatest(kept, 0))::DOUBLE AS savings FROM savings",
    "q23_savings_cutoff_month": """SELECT (min(m) + to_months(14))::TIMESTAMP
        AS savings_as_of FROM savings""",
    "q24_unique_inc_types": "SELECT DISTINCT kind AS income_type FROM recent_income",
    "q25_flt_rows_all_income": """SELECT d::TIMESTAMP AS posted_date,
        amount::DOUBLE AS amount_earned, description AS income_source,
        kind AS income_type FROM recent_income WHERE kind = 'payments | paycheck'""",
    "listing_with_total_row": f"""SELECT {_LISTING}, false AS is_total FROM listing
        WHERE {_has("account_name", "cashreward")}
        UNION ALL BY NAME
        SELECT sum(spent)::DOUBLE AS amount_spent, true AS is_total FROM listing
        WHERE {_has("account_name", "cashreward")}""",
    # Quality
    "quality_unique": """SELECT l_orderkey AS value, count(*) AS n_records
        FROM (SELECT l_orderkey || '-' || l_linenumber AS l_orderkey FROM lineitem)
        GROUP BY 1 HAVING count(*) > 1""",
    "quality_not_null": "SELECT unnest(['txn_id', 'payee', 'amount']) AS column_name,"
    " unnest([count(*) - count(txn_id), count(*) - count(payee),"
    " count(*) - count(amount)]) AS n_nulls FROM fact",
    "quality_not_null_checks": """
        SELECT 'not_null fact.txn_id' AS check_name, 'error' AS severity,
               count(*) AS n_failures, 'pass' AS status FROM fact WHERE txn_id IS NULL
        UNION ALL SELECT 'not_null fact.payee', 'warn', count(*), 'warn' FROM fact
          WHERE payee IS NULL
        UNION ALL SELECT 'not_null fact.amount', 'error', count(*), 'pass' FROM fact
          WHERE amount IS NULL""",
    "quality_relationships": f"""SELECT c_custkey AS value, count(*) AS n_records
        FROM customer WHERE {_MISSING.format(parent="supplier", key="s_suppkey", value="c_custkey")}
        GROUP BY 1""",
    "quality_checks": """
        SELECT 'unique txn_id' AS check_name, 'error' AS severity,
               0::BIGINT AS n_failures, 'pass' AS status
        UNION ALL SELECT 'not_null payee', 'warn', count(*), 'warn' FROM fact
          WHERE payee IS NULL
        UNION ALL SELECT 'unique line', 'error',
          (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber
                                 HAVING count(*) > 1)), 'fail'
        UNION ALL SELECT 'merchant known', 'warn', 0, 'pass'
        UNION ALL SELECT 'no unknown transactions', 'warn', count(*), 'warn' FROM unknown""",
    "quality_category_coverage": """SELECT category AS merchant_category,
        sum(total)::DOUBLE AS net_amount, count(*) AS merchant_keys,
        sum(txns)::BIGINT AS transactions FROM merchant GROUP BY 1""",
    "quality_coverage_summary": """SELECT sum(txns)::BIGINT AS unique_transactions,
        count(*) AS merchant_keys,
        count(*) FILTER (WHERE category = '**UNKNOWN**') AS unknown_keys
        FROM merchant""",
    "quality_unknown_merchants": """SELECT name AS merchant_name,
        txns AS total_transactions FROM merchant WHERE category = '**UNKNOWN**'""",
    "quality_contract": """
        SELECT t AS table_name, c AS column_name, d AS difference, f AS found, w AS wanted,
               m AS mends_itself, CASE WHEN t = 'rpt_unknown_transactions' THEN n END AS rows_conformed
        FROM (VALUES
          ('rpt_income_detail', 'posted_at_timestamp', 'missing', NULL, 'timestamp', false),
          ('rpt_income_detail', 'merchant_subcategory', 'missing', NULL, 'string', false),
          ('rpt_income_detail', 'o_orderdate', 'extra', 'timestamp_ntz', NULL, false),
          ('rpt_income_detail', 'account', 'order', '0', '3', true),
          ('rpt_income_detail', 'merchant_category', 'order', '1', '0', true),
          ('rpt_income_detail', 'merchant', 'order', '2', '1', true),
          ('rpt_income_detail', 'amount_earned', 'type', 'decimal(13,1)', 'decimal(14,2)', true),
          ('rpt_income_detail', 'txn_description', 'type', 'bigint', 'string', false),
          ('rpt_unknown_transactions', 'amount', 'type', 'decimal(12,2)', 'decimal(14,2)', true),
          ('rpt_unknown_transactions', 'merchant_category', 'order', '3', '4', true),
          ('rpt_unknown_transactions', 'txn_description', 'type', 'void', 'string', true)
        ) AS v(t, c, d, f, w, m) CROSS JOIN (SELECT count(*) AS n FROM lineitem)""",
    "quality_catalog_rules": """
        WITH m AS (SELECT split_part(p_name, ' ', 2) || CASE WHEN p_size > 45
                     THEN '+' ELSE '' END AS token, lower(p_type) AS category,
                     p_retailprice AS lo, 900 + p_size * 4 AS hi FROM part)
        SELECT 'duplicate_token' AS check_name, 'warn' AS severity,
               count(*) AS n_failures,
               CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warn' END AS status
          FROM (SELECT token FROM m GROUP BY token HAVING count(*) > 1)
        UNION ALL SELECT 'token_with_metacharacter', 'error', count(*),
               CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
          FROM m WHERE contains(token, '+')
        UNION ALL SELECT 'category_outside_taxonomy', 'warn', count(*), 'warn' FROM m
        UNION ALL SELECT 'amount_min_above_max', 'error', count(*),
               CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END FROM m WHERE lo > hi
        UNION ALL SELECT 'dangling_reference', 'error', count(*),
               CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
          FROM (SELECT DISTINCT lower(s_name) AS t FROM supplier)
          WHERE t NOT IN (SELECT token FROM m)""",
    # Catalog, history, arrivals
    "catalog_build": """
        SELECT lower(p_type) AS merchant_category, p_brand AS merchant_subcategory,
               '^.*(' || string_agg(token, '|' ORDER BY token) || ').*$' AS regex_match_pat,
               min(priority)::INTEGER AS match_priority
        FROM (SELECT p_type, p_brand, split_part(p_name, ' ', 2) AS token,
                     min(CASE WHEN p_size < 5 THEN p_size ELSE 10 END) AS priority
              FROM part GROUP BY ALL) GROUP BY ALL
        UNION ALL
        SELECT 'region', r_name, '^.*(' || lower(r_name) || ' fee).*$', r_regionkey::INTEGER
        FROM region""",
    "catalog_build_large": """
        SELECT nullif(l_returnflag, 'R') AS merchant_category,
               nullif(l_linestatus, 'F') AS merchant_subcategory,
               '^.*(' || string_agg(DISTINCT l_orderkey || '-' || l_linenumber, '|'
                  ORDER BY l_orderkey || '-' || l_linenumber) || ').*$' AS regex_match_pat,
               10::INTEGER AS match_priority
        FROM lineitem GROUP BY ALL""",
    "catalog_overlay": """
        SELECT lower(p_type) AS merchant_category, p_brand AS merchant_subcategory,
               '^.*(' || string_agg(DISTINCT split_part(p_name, ' ', 2), '|'
                  ORDER BY split_part(p_name, ' ', 2)) || ').*$' AS regex_match_pat,
               3::INTEGER AS match_priority
        FROM part GROUP BY ALL""",
    "categorize_large": """
        WITH c AS (SELECT c_custkey, lower(c_name) AS name, lower(c_mktsegment) AS segment, c_nationkey
                   FROM customer),
        rules AS (
          SELECT segment AS category, 'nation ' || c_nationkey AS subcategory, c_custkey % 5 AS priority,
                 CASE WHEN c_custkey % 100 = 99 THEN '^[a-m]+ .*' || c_nationkey || '[05]$'
                      ELSE '^.*(' || name || '|r#' || lpad((c_custkey + 7)::VARCHAR, 9, '0') || ').*$'
                 END AS pattern
          FROM c),
        texts AS (SELECT c_custkey, segment || ' ' || name AS description FROM c),
        hits AS (
          SELECT t.*, r.*, row_number() OVER (PARTITION BY c_custkey
                   ORDER BY priority, category, subcategory, pattern) AS place
          FROM texts t JOIN rules r ON regexp_matches(description, pattern))
        SELECT t.c_custkey, t.description, coalesce(category, '**UNKNOWN**') AS merchant_category,
               coalesce(subcategory, '**UNKNOWN**') AS merchant_subcategory,
               priority::INTEGER AS match_priority
        FROM texts t LEFT JOIN hits h ON h.c_custkey = t.c_custkey AND place = 1""",
    "catalog_csv_scan": """
        SELECT lower(p_type) AS merchant_category, p_brand AS merchant_subcategory,
               '^.*(' || string_agg(DISTINCT split_part(p_name, ' ', 2), '|'
                  ORDER BY split_part(p_name, ' ', 2)) || ').*$' AS regex_match_pat,
               10::INTEGER AS match_priority
        FROM part GROUP BY ALL""",
    "balance_as_of": """
        SELECT account_name AS account, moment::TIMESTAMP AS as_of_date,
               (1000 - coalesce(sum(amount) FILTER (WHERE posted > moment), 0))::DOUBLE AS balance
        FROM fact CROSS JOIN as_of_days GROUP BY ALL""",
    "trailing_snapshot": """
        SELECT as_of_date, bank_account_name,
               row_number() OVER (PARTITION BY as_of_date, bank_account_name
                                  ORDER BY posted DESC, id) AS position,
               id, posted, amount, description, payee
        FROM (SELECT moment::TIMESTAMP AS as_of_date,
                     CASE WHEN account_name NOT LIKE '%7' THEN account_name END AS bank_account_name,
                     txn_id AS id, epoch(posted)::BIGINT AS posted,
                     amount::VARCHAR AS amount, description, payee
              FROM fact JOIN as_of_days ON posted::DATE BETWEEN moment - 88 AND moment)""",
    "trailing_snapshot_hot": """
        SELECT as_of_date, bank_account_name,
               row_number() OVER (PARTITION BY as_of_date, bank_account_name
                                  ORDER BY posted DESC, id) AS position, id
        FROM (SELECT moment::TIMESTAMP AS as_of_date, bank_account_name, id, posted
              FROM (SELECT CASE WHEN hot THEN 'Busy' ELSE account_name END AS bank_account_name,
                           txn_id AS id, CASE WHEN hot THEN TIMESTAMP '2001-06-01' ELSE posted END AS posted
                    FROM (SELECT *, split_part(txn_id, '-', 1)::BIGINT % 3 = 0 AS hot FROM fact))
              JOIN as_of_days ON posted::DATE BETWEEN moment - 88 AND moment)""",
    "snapshot_scan_accounts": f"""
        SELECT account_id AS bank_account_id, account_name AS bank_account_name,
               'USD' AS currency, balance::DOUBLE AS actual_balance,
               (balance - 1)::DOUBLE AS available_balance,
               TIMESTAMP '{AS_OF}' AS balance_as_of_timestamp
        FROM (SELECT max(account_id) AS account_id, account_name,
                     1000 - coalesce(sum(amount) FILTER (WHERE posted > DATE '{AS_OF}'), 0) AS balance
              FROM fact GROUP BY account_name)""",
    "snapshot_scan_documents": """
        SELECT id AS bank_account_id, name AS bank_account_name, 'USD' AS currency,
               bal::DOUBLE AS actual_balance, avail::DOUBLE AS available_balance,
               moment AS balance_as_of_timestamp, strftime(moment, '%Y-%m-%d') AS filename
        FROM offered""",
    "snapshot_scan_fact": """
        SELECT account_name AS bank_account_name, txn_id, description AS txn_description,
               merchant AS merchant_category_key, payee, amount::DOUBLE AS amount,
               posted AS posted_at_timestamp
        FROM fact WHERE EXISTS (SELECT 1 FROM as_of_days
                                WHERE posted::DATE BETWEEN moment - 88 AND moment)""",
    "snapshot_freshness": """
        SELECT 'order-' || o_orderkey AS filename,
               nullif(epoch(o_orderdate)::BIGINT, 0) AS balance_epoch,
               2::INTEGER AS n_accounts
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "snapshot_admission": f"""
        SELECT 'order-' || o_orderkey AS filename,
               CASE WHEN epoch(o_orderdate) <= (SELECT epoch(max(o_orderdate)) FROM orders
                                                WHERE o_orderdate < DATE '{AS_OF}')
                    THEN 'not_newer' ELSE 'new' END AS decision,
               CASE WHEN epoch(o_orderdate) > (SELECT epoch(max(o_orderdate)) FROM orders
                                               WHERE o_orderdate < DATE '{AS_OF}')
                    THEN epoch(o_orderdate)::BIGINT END AS marker
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "snapshot_admission_unreadable": _judged_days(2),
    "snapshot_admission_by_day": _judged_days(10),
    "freshness_names": f"""
        SELECT 's3a://bucket/transactions/' || strftime(o_orderdate, '%Y/%m/%d') || '/' || o_orderkey
                 || CASE WHEN o_orderkey % 3 = 0 THEN 'Z.json'
                         ELSE 'Z_bd' || epoch(o_orderdate)::BIGINT || '.json' END AS filename,
               CASE WHEN o_orderkey % 3 <> 0 THEN epoch(o_orderdate)::BIGINT END AS balance_epoch,
               o_orderdate::DATE BETWEEN DATE '{AS_OF}' - 1 AND DATE '{AS_OF}' AS recent
        FROM orders""",
    "freshness_listing": """
        SELECT DISTINCT strftime(day, '%Y-%m-%d') || CASE WHEN bare THEN 'Z.json'
                 ELSE 'Z_bd' || epoch(day)::BIGINT || '.json' END AS filename,
               CASE WHEN NOT bare THEN epoch(day)::BIGINT END AS balance_epoch
        FROM (SELECT o_orderdate::DATE AS day, (o_orderdate::DATE - DATE '1970-01-01') % 3 = 0 AS bare
              FROM orders)""",
    # Streams
    "stream_two_checkpoints": _FACT,
    "stream_late_backfill": "SELECT txn_id FROM fact",
    "stream_latest_transactions": _FACT,
    "stream_first_seen": "SELECT txn_id FROM fact",
    "stream_json_snapshots": """
        SELECT id AS bank_account_id, name AS bank_account_name, 'USD' AS currency,
               bal::DOUBLE AS actual_balance, avail::DOUBLE AS available_balance,
               moment AS balance_as_of_timestamp, strftime(moment, '%Y-%m-%d') AS filename,
               NULL::VARCHAR AS reason
        FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY moment DESC, id DESC) AS r
              FROM offered WHERE (moment::DATE - DATE '1970-01-01') % 10 <> 0)
        WHERE r = 1
        UNION ALL
        SELECT DISTINCT NULL, NULL, NULL, NULL, NULL, NULL::TIMESTAMP, strftime(moment, '%Y-%m-%d'), 'not json'
        FROM offered WHERE (moment::DATE - DATE '1970-01-01') % 10 = 0""",
    "stream_latest_accounts": """SELECT id AS bank_account_id,
        name AS bank_account_name, 'USD' AS currency, bal::DOUBLE AS actual_balance,
        avail::DOUBLE AS available_balance, moment AS balance_as_of_timestamp, filename
        FROM accounts""",
}

def _positions(select: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({select})"


def _ascending(names: str) -> str:
    return ", ".join(f"{name} ASC NULLS LAST" for name in names.split())


SELECTS["positions_all_expenses"] = _positions(
    SELECTS["q10_rows_all_expenses"],
    "posted_date DESC NULLS LAST, " + _ascending("amount_spent merchant category subcategory description account"),
)
SELECTS["positions_expense_categories"] = _positions(
    "SELECT category, subcategory, sum(spent)::DOUBLE AS total_spend FROM listing GROUP BY ALL",
    _ascending("category subcategory total_spend"),
)
SELECTS["positions_top_expenses"] = _positions(
    SELECTS["top_expenses"],
    "total_spend DESC NULLS LAST, "
    + _ascending(
        "merchant_name category subcategory past_day past_week past_month past_quarter past_year"
        " earliest_txn_at latest_txn_at total_transactions avg_spend_per_txn"
    ),
)

# A build, and a refresh after late rows, end in the same tables.  There, rows of one id and
# time come from one file, so the order by file does not choose among them.
OF_BUILD = {
    "build_monthly_savings": SELECTS["monthly_savings"],
    "build_fact_transactions": _FACT.replace(", filename FROM", " FROM"),
    "build_daily_pay": SELECTS["daily_pay"],
    "refresh_fact_transactions": _FACT.replace(", filename FROM", " FROM"),
} | {
    f"refresh_{name}": SELECTS[name]
    for name in (
        "dim_merchant",
        "expenses_detail",
        "income_detail",
        "unknown_transactions",
        "daily_overunder",
        "monthly_savings",
        "mom_performance",
        "top_expenses",
    )
}


def _of_build(select: str) -> str:
    return compose(select).replace("ORDER BY posted DESC,\n                filename DESC, ", "ORDER BY posted DESC, ")


def oracle_sql() -> dict[str, str]:
    found = {name: compose(select) for name, select in SELECTS.items()}
    return found | {name: _of_build(select) for name, select in OF_BUILD.items()}
