"""Ledger-shaped inputs derived from the driver's order tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passbook.operators.lookup import small
from passbook.plans import marts, star
from passbook.schemas import CONTRACTS
from passbook.session import configure, scratch_path, shared_dir
from passbook.sources.folders import remove_folder
from passbook.sources.inline import literal_table
from passbook.sources.tables import read_table, write_table

AS_OF = "2001-06-15"
LOADED_AT = "2001-12-31 00:00:00"

PRODUCTS = {
    "AUTOMOBILE": "Cashrewards Card",
    "BUILDING": "Everyday Checking",
    "FURNITURE": "Mortgage Loan",
    "HOUSEHOLD": "Market Savings",
    "MACHINERY": "Share Savings",
}

# Category, subcategory, pattern, priority.  "widget" has none, "old" and "hot"
# tie with the nouns, interest beats them, transfers beat everything.
CATALOG = [
    ("cost-of-living", "grocery", r"^.*(bolt|gear).*$", 10),
    ("cost-of-living", "gas", r"^.*(anvil).*$", 10),
    ("going-out", "restaurants", r"^.*(gizmo).*$", 10),
    ("vice", "kratom", r"^.*(red plate).*$", 5),
    ("home-goods", "amenities", r"^.*(plate).*$", 10),
    ("payments", "paycheck", r"^.*(ring|rod).*$", 10),
    ("discretional", "vintage", r"^.*(old [a-v]).*$", 10),
    ("going-out", "bars", r"^.*(hot +[a-g]).*$", 10),
    ("debt", "interest", r"^.*(interest charge).*$", 7),
    ("debt", "credit card payment", r"^.*(transfer to credit card).*$", 5),
    ("debt", "mortgage", r"^.*(transfer to mortgage).*$", 5),
    ("transfers", "other account", r"^.*(transfer to|transfer from).*$", 6),
]

# Employer, address, biweekly pay, first day, last day: a gap in early 1997, an
# overlap in late 1999, and single days set to meet that day's spending.
PAY_RATES = [
    ("Acme Works", "1 Mill Lane", "40000.00", "1995-01-01", "1996-12-31"),
    ("Borden Supply", "2 Quay Street", "55000.00", "1997-04-01", "1999-12-31"),
    ("Carver Tools", "3 Hill Road", "75000.00", "1999-07-01", "9999-12-31"),
    ("Level Pay", "4 Even Lane", "4790.85", "1996-06-10", "1996-06-10"),
    ("Level Pay", "4 Even Lane", "26371.65", "1998-09-09", "1998-09-09"),
    ("Level Pay", "4 Even Lane", "78040.95", "2000-11-20", "2000-11-20"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mapped(col: Column, mapping: dict[str, str]) -> Column:
    result = F.lit(None).cast("string")
    for key, value in mapping.items():
        result = F.when(col == key, value).otherwise(result)
    return result


def cents(price: Column) -> Column:
    """Whole units of a price read as cents, exactly."""
    return (F.floor(price).cast("decimal(14,0)") * F.expr("0.01BD")).cast("decimal(14,2)")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat ledger rows, with repeated ids and near duplicates."""
    price = cents(F.col("l_extendedprice"))
    returned = F.col("l_returnflag") == "R"
    # Rows are narrowed before they are shuffled for a join: few columns, each text made up already.
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.when(returned, price).otherwise((-price).cast("decimal(14,2)")).alias("amount"),
        (returned & (F.col("l_linestatus") == "F")).alias("again"),
        "l_shipdate",
    )
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat_ws(" ", _mapped(F.col("c_mktsegment"), PRODUCTS), "c_name").alias("account"),
    )
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat_ws(" ", "p_type", "p_name").alias("text"),
        F.when(F.col("p_brand") != "Brand#25", F.col("p_brand")).alias("payee"),
    )

    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    urgent = priority == "1-URGENT"
    prefix = (
        F.when(urgent & (status == "F"), "Transfer to credit card ")
        .when(urgent & (status == "O"), "Transfer to mortgage ")
        .when(urgent, "Transfer to savings ")
        .when((priority == "2-HIGH") & (status == "F"), "Interest charge on ")
        .otherwise("")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", prefix.alias("prefix"))
    suffixes = F.when(F.col("again"), F.array(F.lit(""), F.lit("-again"))).otherwise(F.array(F.lit("")))
    # Orders meet their customers first, as there are fewer of them than lines.
    orders = orders.join(customer, orders.o_custkey == customer.c_custkey)
    # Parts come before orders: their texts are few, so lines shuffle well with them, and in the
    # end the lines of an order, where ids repeat, lie side by side.
    return (
        line.join(part, line.l_partkey == part.p_partkey)
        .join(orders, line.l_orderkey == orders.o_orderkey)
        .select(
            F.col("o_custkey").cast("string").alias("bank_account_id"),
            F.col("account").alias("bank_account_name"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("txn_id"),
            F.concat("prefix", "text").alias("txn_description"),
            "payee",
            "amount",
            F.col("l_shipdate").cast("timestamp").alias("posted_at_timestamp"),
            F.concat_ws("/", "l_partkey", "l_suppkey").alias("filename"),
            F.explode(suffixes).alias("suffix"),
        )
        .withColumn("txn_id", F.concat("txn_id", "suffix"))
        .drop("suffix")
    )


def account_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot document per order, holding its customer's two accounts."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    customer = table(spark, sf_dir, "customer")
    epoch = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    product = _mapped(F.col("c_mktsegment"), PRODUCTS)
    none = F.array().cast(
        "array<struct<id:string,posted:bigint,amount:string,description:string,"
        "payee:string,memo:string,transacted_at:bigint,mcc:string>>"
    )

    def account(name: Column, balance: Column, key: Column) -> Column:
        return F.struct(
            key.alias("id"),
            name.alias("name"),
            F.lit("USD").alias("currency"),
            balance.alias("balance"),
            F.when(F.col("o_orderstatus") == "P", "n/a")
            .otherwise(balance)
            .alias("available-balance"),
            epoch.alias("balance-date"),
            none.alias("transactions"),
        )

    balance = F.col("o_totalprice").cast("decimal(14,2)").cast("string")
    credit = F.col("c_acctbal").cast("decimal(14,2)").cast("string")
    key = F.col("o_orderkey").cast("string")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.array(
            account(F.concat_ws(" ", product, "c_name"), balance, key),
            account(F.concat(F.lit("Reserve "), "c_name"), credit, key),
        ).alias("accounts"),
        F.concat(F.lit("order-"), key).alias("filename"),
    )


def transaction_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as nested documents, one account and transaction each."""
    return documents_of(ledger(spark, sf_dir)).select("accounts", "filename")


def documents_of(flat: DataFrame) -> DataFrame:
    """One document a row in ``accounts``, beside all other columns."""
    posted = F.unix_timestamp("posted_at_timestamp")
    txn = F.struct(
        F.col("txn_id").alias("id"),
        posted.alias("posted"),
        F.col("amount").cast("string").alias("amount"),
        F.col("txn_description").alias("description"),
        F.col("payee").alias("payee"),
    )
    account = F.struct(
        F.col("bank_account_id").alias("id"),
        F.col("bank_account_name").alias("name"),
        F.array(txn).alias("transactions"),
    )
    return flat.withColumn("accounts", F.array(account))


def catalog(spark: SparkSession) -> DataFrame:
    return literal_table(spark, CATALOG, CONTRACTS["map_merchant_category_regex"])


def pay_rates(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PAY_RATES, CONTRACTS["stg_payrate"])


# The detail marts, as filters over labelled transactions.
DETAILS = {
    "rpt_expenses_detail": marts.expenses_of,
    "rpt_income_detail": marts.income_of,
    "rpt_unknown_transactions": marts.unknown_of,
}


# Like texts side by side are stored best, and shuffled best when a report sorts them.
LIKE_TEXTS = {
    "rpt_expenses_detail": ["txn_description", "merchant", "account"],
    "rpt_income_detail": ["txn_description", "merchant", "account"],
}


class Warehouse:
    """Tables of one data directory, each built once and read from parquet.

    This is how the tables are used in production: a builder writes its table,
    consumers scan it.  ``plan`` gives a table's builder over the stored tables
    it depends on; ``table`` stores it first.
    """

    _stored: dict[tuple[str, str, str], DataFrame] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        app = spark.sparkContext.applicationId
        self._key = (app, sf_dir)
        digest = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
        self.root = f"{shared_dir(spark)}/{app}/warehouse-{digest}"

    def plan(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    def table(self, name: str) -> DataFrame:
        self.tables(name)
        return self._stored[(*self._key, name)]

    def tables(self, *names: str) -> list[DataFrame]:
        """Stored tables; details that are asked for together share one collapse and one join."""
        scratch: list[str] = []

        def staged(df: DataFrame, name: str) -> DataFrame:
            scratch.append(scratch_path(self.spark, name))
            df.write.parquet(scratch[-1])
            return self.spark.read.schema(df.schema).parquet(scratch[-1])

        missing = [name for name in DETAILS if name in names and (*self._key, name) not in self._stored]
        if missing:
            fact, merchants = self.tables("fact_transactions", "dim_merchant")
            labelled = marts.labelled_transactions(fact, small(merchants), staged).select(*marts.LABELLED)
            if len(missing) > 1:
                labelled = staged(labelled.sortWithinPartitions(*marts.LIKE_TEXTS), "labelled")
            for name in missing:
                self._store(name, DETAILS[name](labelled))
        for name in names:
            if (*self._key, name) in self._stored:
                continue
            if name == "fact_transactions":
                # The ledger is stored, so that of its whole rows only those whose id may repeat are shuffled.
                rows = staged(ledger(self.spark, self.sf_dir), "ledger")
                self._store(name, star.as_fact(star.latest_of_stored(rows, staged), LOADED_AT))
            else:
                self._store(name, self.plan(name))
        for path in scratch:
            remove_folder(self.spark, path)
        return [self._stored[(*self._key, name)] for name in names]

    def _store(self, name: str, rows: DataFrame) -> None:
        key = (*self._key, name)
        write_table(rows, self.root, name, LIKE_TEXTS.get(name))
        self._stored[key] = read_table(self.spark, self.root, name)

    def _dim_accounts(self) -> DataFrame:
        return star.dim_accounts(account_snapshots(self.spark, self.sf_dir), LOADED_AT)

    def _fact_transactions(self) -> DataFrame:
        return star.fact_from_flat(ledger(self.spark, self.sf_dir), LOADED_AT)

    def _dim_merchant(self) -> DataFrame:
        fact = self.table("fact_transactions")
        return star.dim_merchant(fact, catalog(self.spark), LOADED_AT)

    def calendar(self, corrected: bool = False) -> DataFrame:
        """Every day from the first to the last posting."""
        day = F.col("posted_at_timestamp").cast("date")
        fact = self.table("fact_transactions")
        first = fact.agg(F.min(day)).scalar()
        last = fact.agg(F.max(day)).scalar()
        return star.dim_date(self.spark, first, F.date_add(last, 1), corrected)

    def _dim_date(self) -> DataFrame:
        return self.calendar()

    def _fact_daily_pay(self) -> DataFrame:
        return star.fact_daily_pay(self.table("dim_date"), pay_rates(self.spark), AS_OF)

    def _rpt_expenses_detail(self) -> DataFrame:
        return marts.rpt_expenses_detail(
            self.table("fact_transactions"), small(self.table("dim_merchant"))
        )

    def _rpt_income_detail(self) -> DataFrame:
        return marts.rpt_income_detail(
            self.table("fact_transactions"), small(self.table("dim_merchant"))
        )

    def _rpt_unknown_transactions(self) -> DataFrame:
        return marts.rpt_unknown_transactions(
            self.table("fact_transactions"), small(self.table("dim_merchant"))
        )

    def _rpt_daily_overunder(self) -> DataFrame:
        return marts.rpt_daily_overunder(
            self.table("rpt_expenses_detail"), self.table("fact_daily_pay")
        )

    def _rpt_monthly_savings(self) -> DataFrame:
        return marts.rpt_monthly_savings(*self.tables("rpt_expenses_detail", "rpt_income_detail"))

    def _rpt_mom_performance(self) -> DataFrame:
        return marts.rpt_mom_performance(
            self.table("fact_transactions"), self.table("rpt_daily_overunder"), AS_OF
        )

    def _rpt_top_expenses(self) -> DataFrame:
        return marts.rpt_top_expenses(self.table("dim_merchant"))
