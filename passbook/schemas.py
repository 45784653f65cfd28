"""Read schemas of the raw inputs and contracts of every modelled table."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
BIGINT = T.LongType()
INT = T.IntegerType()
# Unsigned 8-bit columns are held as SMALLINT; see functions.calendar.utinyint.
BYTE = T.ShortType()
FLAG = T.BooleanType()
DATE = T.DateType()
INSTANT = T.TimestampType()


def _money(precision: int, scale: int = 2) -> T.DecimalType:
    return T.DecimalType(precision, scale)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


TRANSACTION = _struct(
    id=TEXT,
    posted=BIGINT,
    amount=TEXT,
    description=TEXT,
    payee=TEXT,
    memo=TEXT,
    transacted_at=BIGINT,
    mcc=TEXT,
)

ORG = _struct(domain=TEXT, name=TEXT, **{"sfin-url": TEXT}, url=TEXT, id=TEXT)

ACCOUNT = _struct(
    id=TEXT,
    name=TEXT,
    currency=TEXT,
    balance=TEXT,
    **{"available-balance": TEXT, "balance-date": BIGINT},
    transactions=T.ArrayType(TRANSACTION),
    holdings=T.ArrayType(TEXT),
    org=ORG,
)

SNAPSHOT = _struct(errors=T.ArrayType(TEXT), accounts=T.ArrayType(ACCOUNT))

# One row per transaction per snapshot, before deduplication.
FLAT_TRANSACTION = _struct(
    bank_account_id=TEXT,
    bank_account_name=TEXT,
    txn_id=TEXT,
    txn_description=TEXT,
    payee=TEXT,
    amount=_money(14),
    posted_at_timestamp=INSTANT,
    filename=TEXT,
)

# One row per account per snapshot.
FLAT_ACCOUNT = _struct(
    bank_account_id=TEXT,
    bank_account_name=TEXT,
    currency=TEXT,
    actual_balance=_money(14),
    available_balance=_money(14),
    balance_as_of_timestamp=INSTANT,
    filename=TEXT,
)

_MOM_COUNTS = {
    name: dtype
    for color in ("green", "red", "grey", "black")
    for name, dtype in (
        (f"total_{color}_days", BYTE),
        (f"last_month_total_{color}_days", BYTE),
        (f"mom_total_{color}_days_change", _money(12)),
        (f"pcnt_mom_total_{color}_days", _money(14, 4)),
    )
}

CONTRACTS: dict[str, T.StructType] = {
    "map_merchant_category_regex": _struct(
        merchant_category=TEXT,
        merchant_subcategory=TEXT,
        regex_match_pat=TEXT,
        match_priority=INT,
    ),
    "stg_payrate": _struct(
        employer_name=TEXT,
        employer_address=TEXT,
        biweekly_paycheck_posttax_amount=_money(12),
        effective_start_date=DATE,
        effective_end_date=DATE,
    ),
    "dim_accounts": _struct(
        bank_account_id=TEXT,
        bank_account_name=TEXT,
        currency=TEXT,
        actual_balance=_money(14),
        available_balance=_money(14),
        balance_as_of_timestamp=INSTANT,
        filename=TEXT,
        record_loaded_at_timestamp=INSTANT,
    ),
    "fact_transactions": _struct(
        bank_account_id=TEXT,
        bank_account_name=TEXT,
        txn_id=TEXT,
        txn_description=TEXT,
        merchant_category_key=TEXT,
        payee=TEXT,
        amount=_money(14),
        posted_at_timestamp=INSTANT,
        filename=TEXT,
        record_loaded_at_timestamp=INSTANT,
    ),
    "dim_date": _struct(
        full_date=DATE,
        date_year=BYTE,
        date_quarter=BYTE,
        date_month=BYTE,
        name_date_month=TEXT,
        total_days_in_month=BYTE,
        date_week=BYTE,
        day_of_week=BYTE,
        name_day_of_week=TEXT,
        is_weekend_ind=FLAG,
    ),
    "fact_daily_pay": _struct(
        calendar_date=DATE,
        calendar_quarter=BYTE,
        daily_income=_money(12),
        from_employer=TEXT,
    ),
    "dim_merchant": _struct(
        merchant_category_key=TEXT,
        merchant_name=TEXT,
        merchant_category=TEXT,
        merchant_subcategory=TEXT,
        earliest_txn_at=INSTANT,
        latest_txn_at=INSTANT,
        total_transactions=BIGINT,
        amount_past_day=_money(38),
        amount_past_week=_money(38),
        amount_past_month=_money(38),
        amount_past_quarter=_money(38),
        amount_past_year=_money(38),
        total_amount=_money(38),
        record_updated_at=INSTANT,
    ),
    "rpt_expenses_detail": _struct(
        posted_at_timestamp=INSTANT,
        merchant_category=TEXT,
        merchant_subcategory=TEXT,
        merchant=TEXT,
        txn_description=TEXT,
        account=TEXT,
        amount_spent=_money(18),
    ),
    "rpt_income_detail": _struct(
        posted_at_timestamp=INSTANT,
        merchant_category=TEXT,
        merchant_subcategory=TEXT,
        merchant=TEXT,
        txn_description=TEXT,
        account=TEXT,
        amount_earned=_money(14),
    ),
    "rpt_unknown_transactions": _struct(
        amount=_money(14),
        posted_at_timestamp=INSTANT,
        payee=TEXT,
        txn_description=TEXT,
        merchant_category=TEXT,
    ),
    "rpt_daily_overunder": _struct(
        calendar_date=DATE,
        daily_income=_money(12),
        daily_spend=_money(12),
        dollars_over=_money(12),
        dollars_under=_money(12),
        day_color=TEXT,
    ),
    "rpt_monthly_savings": _struct(
        year_month=DATE,
        total_spend=_money(38),
        total_earned=_money(38),
        dollars_saved=_money(38),
        pcnt_saved=_money(36, 4),
        dollars_lost=_money(38),
        pcnt_lost=_money(36, 4),
    ),
    "rpt_mom_performance": _struct(
        as_of_date=DATE,
        year=BYTE,
        month=BYTE,
        current_monthly_balance=_money(12),
        this_time_last_month_balance=_money(12),
        dollars_mom_balance_delta=_money(12),
        pcnt_mom_balance_delta=_money(14, 4),
        avg_daily_spend=_money(12),
        last_month_avg_daily_spend=_money(12),
        dollars_mom_avg_daily_spend_delta=_money(12),
        pcnt_mom_avg_daily_spend_delta=_money(14, 4),
        **_MOM_COUNTS,
    ),
    "rpt_top_expenses": _struct(
        merchant_name=TEXT,
        category=TEXT,
        subcategory=TEXT,
        total_spend=_money(38),
        past_day=_money(38),
        past_week=_money(38),
        past_month=_money(38),
        past_quarter=_money(38),
        past_year=_money(38),
        earliest_txn_at=INSTANT,
        latest_txn_at=INSTANT,
        total_transactions=BIGINT,
        avg_spend_per_txn=_money(38),
    ),
}
