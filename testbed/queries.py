"""Every registered query over the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.operators import quality
from passbook.operators.categorize import UNKNOWN, categorize
from passbook.operators.contract import conform, drift_report
from passbook.operators.listing import with_total_row
from passbook.operators.position import numbered
from passbook.plans import arrivals, catalog, history, marts, reports, star
from passbook.plans.build import build_all
from passbook.plans.refresh import refresh_all
from passbook.session import configure, scratch_path
from passbook.sources.seeds import merchant_catalog
from passbook.sources.snapshots import (
    SNAPSHOT_GLOB,
    flatten_accounts,
    list_files,
    read_arrivals,
    read_snapshots,
    stream_documents,
)
from passbook.sources.tables import read_table
from passbook.streaming.ingest import (
    absorb_available,
    absorb_documents,
    account_store,
    append_available,
    first_seen,
    read_dead_letters,
    transaction_store,
)
from testbed.ledger import (
    AS_OF,
    LOADED_AT,
    Warehouse,
    account_snapshots,
    documents_of,
    ledger,
    table,
    transaction_snapshots,
)
from testbed.ledger import catalog as testbed_catalog
from testbed.ledger import pay_rates as testbed_pay

Query = Callable[[SparkSession, str], DataFrame]

HISTORY = {"as_of": AS_OF, "start": "1995-01-01", "every_days": 60}

LOAD_TIMES = ("record_loaded_at_timestamp", "record_updated_at")


def comparable(df: DataFrame) -> DataFrame:
    """Column types that read the same from any engine; no load times."""

    def plain(field: T.StructField):
        col = F.col(field.name)
        match field.dataType:
            case T.DecimalType():
                return col.cast("double").alias(field.name)
            case T.TimestampType() | T.DateType():
                return col.cast("timestamp_ntz").alias(field.name)
            case T.ShortType():
                return col.cast("int").alias(field.name)
        return col

    return df.select(*[plain(f) for f in df.schema if f.name not in LOAD_TIMES])


def _report(build: Callable[..., DataFrame], *tables: str, **options: object) -> Query:
    """A query over stored tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = Warehouse(spark, sf_dir)
        return build(*warehouse.tables(*tables), **options)

    return run


def _built(name: str) -> Query:
    """A table's own builder over the stored tables it depends on."""
    return lambda spark, sf_dir: Warehouse(spark, sf_dir).plan(name)


# Sources ------------------------------------------------------------------


def fact_from_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_transactions(transaction_snapshots(spark, sf_dir), LOADED_AT)


def merchant_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a merchant table: the noun of the name is the token."""
    return table(spark, sf_dir, "part").select(
        F.lower("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("token"),
        F.when(F.col("p_size") < 5, F.col("p_size")).alias("priority"),
    )


def catalog_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    structural = table(spark, sf_dir, "region").select(
        F.lit("region").alias("category"),
        F.col("r_name").alias("subcategory"),
        F.concat(F.lower("r_name"), F.lit(" fee")).alias("regex"),
        F.col("r_regionkey").alias("priority"),
    )
    return catalog.build_catalog(merchant_tokens(spark, sf_dir), structural)


def catalog_build_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers as tokens: groups of many thousands, and NULL group names."""
    line = table(spark, sf_dir, "lineitem")
    merchants = line.select(
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("category"),
        F.when(F.col("l_linestatus") != "F", F.col("l_linestatus")).alias("subcategory"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("token"),
        F.lit(None).cast("int").alias("priority"),
    )
    return catalog.build_catalog(merchants)


def catalog_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default catalog with derived rows laid over it, from CSV."""
    tokens = merchant_tokens(spark, sf_dir).withColumn("priority", F.lit(3))
    path = scratch_path(spark, "overlay-csv")
    catalog.build_catalog(tokens).write.option("header", True).option("escape", '"').csv(path)
    both = merchant_catalog(spark, overlay=path)
    base = merchant_catalog(spark)
    return both.join(base, both.columns, "left_anti")


def catalog_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A derived catalog written as CSV and scanned back as a replacement."""
    tokens = merchant_tokens(spark, sf_dir).withColumn("priority", F.lit(None).cast("int"))
    path = scratch_path(spark, "catalog-csv")
    catalog.build_catalog(tokens).write.option("header", True).option("escape", '"').csv(path)
    return merchant_catalog(spark, replacement=path)


# History ------------------------------------------------------------------


def balance_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = Warehouse(spark, sf_dir).table("fact_transactions")
    moves = fact.withColumnRenamed("bank_account_name", "account")
    accounts = moves.select("account").distinct().withColumn("end_balance", F.lit(1000))
    return history.balances_as_of(accounts, moves, **HISTORY)


def _without_some_names(fact: DataFrame) -> DataFrame:
    name = F.col("bank_account_name")
    return fact.withColumn("bank_account_name", F.when(~name.endswith("7"), name))


def trailing_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every snapshot's rows in order, some of accounts without a name."""
    fact = _without_some_names(Warehouse(spark, sf_dir).table("fact_transactions"))
    columns = ("amount", "txn_description", "payee")
    return history.trailing_rows(fact, **HISTORY, columns=columns).select(
        "as_of_date",
        "bank_account_name",
        "position",
        F.col("txn_id").alias("id"),
        F.unix_seconds("posted_at_timestamp").alias("posted"),
        F.col("amount").cast("string").alias("amount"),
        F.col("txn_description").alias("description"),
        "payee",
    )


def trailing_snapshot_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions when one day of one account holds a third of all rows."""
    fact = Warehouse(spark, sf_dir).table("fact_transactions")
    hot = F.split_part("txn_id", F.lit("-"), F.lit(1)).cast("long") % 3 == 0
    fact = fact.withColumns(
        {
            "bank_account_name": F.when(hot, "Busy").otherwise(F.col("bank_account_name")),
            "posted_at_timestamp": F.when(hot, F.lit("2001-06-01").cast("timestamp")).otherwise(
                F.col("posted_at_timestamp")
            ),
        }
    )
    return history.trailing_rows(fact, **HISTORY, columns=()).select(
        "as_of_date", "bank_account_name", "position", F.col("txn_id").alias("id")
    )


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing snapshots with balances, written as JSON and scanned again."""
    fact = Warehouse(spark, sf_dir).table("fact_transactions")
    ids = fact.groupBy(F.col("bank_account_name").alias("account")).agg(
        F.max("bank_account_id").alias("bank_account_id")
    )
    balances = balance_as_of(spark, sf_dir).join(ids, "account").select(
        "as_of_date",
        F.col("account").alias("bank_account_name"),
        "bank_account_id",
        "balance",
        (F.col("balance") - 1).cast("decimal(14,2)").alias("available_balance"),
    )
    nested = history.trailing_snapshots(fact, **HISTORY)
    documents = history.snapshot_documents(nested, balances, "Bank")
    root = scratch_path(spark, "snapshots")
    # Snapshots overlap, so their text repeats itself; a file is what one task wrote.
    writer = documents.write.option("ignoreNullFields", False).option("compression", "gzip")
    writer.json(f"{root}/transactions/2001/06/15")
    return read_snapshots(spark, root, f"{SNAPSHOT_GLOB}.gz", one_document_per_file=False)


def snapshot_scan_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _documents(spark, sf_dir)
    return star.fact_transactions(raw, LOADED_AT).drop("bank_account_id", "filename")


def snapshot_scan_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest balance of each account, out of the written documents."""
    return star.dim_accounts(_documents(spark, sf_dir), LOADED_AT).drop("filename")


def categorize_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer against a catalog with a pattern for every customer.

    A pattern names two customers, some end in a class, and a few have no literal text.
    """
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.lower("c_name").alias("name"), F.lower("c_mktsegment").alias("segment"), "c_nationkey"
    )
    other = F.lpad((F.col("c_custkey") + 7).cast("string"), 9, "0")
    pattern = F.when(
        F.col("c_custkey") % 100 == 99, F.concat(F.lit("^[a-m]+ .*"), F.col("c_nationkey"), F.lit("[05]$"))
    ).otherwise(F.concat(F.lit("^.*("), F.col("name"), F.lit("|r#"), other, F.lit(").*$")))
    rules = customer.select(
        F.col("segment").alias("merchant_category"),
        F.concat(F.lit("nation "), "c_nationkey").alias("merchant_subcategory"),
        pattern.alias("regex_match_pat"),
        (F.col("c_custkey") % 5).cast("int").alias("match_priority"),
    )
    texts = customer.select("c_custkey", F.concat_ws(" ", "segment", "name").alias("description"))
    return categorize(texts, rules, "description")


# Arrivals -----------------------------------------------------------------


def snapshot_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrivals.freshness_from_content(account_snapshots(spark, sf_dir))


def snapshot_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order document against the ones stored before the as-of date."""
    candidates = snapshot_freshness(spark, sf_dir)
    cut = F.unix_timestamp(F.lit(AS_OF).cast("timestamp"))
    stored = candidates.where(F.col("balance_epoch") < cut)
    decided = arrivals.admit(candidates, stored, f"{AS_OF} 18:00:00")
    return decided.select("filename", "decision", "marker")


def _daily_documents(
    spark: SparkSession, sf_dir: str, name: str, cut_every: int | None = None, indent: bool = False
) -> str:
    """Every order, in one file for each order date; the root of the files.

    The file of every ``cut_every``-th day is cut short.  A day is one string here, which
    suits a test's data; nothing of the library builds files this way.
    """
    orders = account_snapshots(spark, sf_dir).select(
        F.to_date(F.timestamp_seconds(F.col("accounts")[0]["balance-date"])).alias("day"), "accounts"
    )
    days = orders.groupBy("day").agg(F.flatten(F.collect_list("accounts")).alias("accounts"))
    document = F.struct(F.array().cast("array<string>").alias("errors"), "accounts")
    text = F.to_json(document, {"pretty": str(indent).lower()})
    if cut_every:
        short = F.left(text, F.length(text) / 2)
        text = F.when(F.unix_date("day") % cut_every == 0, short).otherwise(text)
    root = scratch_path(spark, name)
    # The rows of a day are in one task, so its folder gets one file.
    files = days.select(text.alias("value"), F.date_format("day", "yyyy-MM-dd").alias("name"))
    files.write.partitionBy("name").text(f"{root}/transactions/2001/06/15")
    return root


DAILY_GLOB = "transactions/*/*/*/*/*.txt"


def _day_of(filename: str = "filename"):
    return F.regexp_extract(filename, "name=([0-9-]+)", 1)


def _judged_days(spark: SparkSession, sf_dir: str, cut_every: int) -> DataFrame:
    """Each day's file judged with nothing stored, with the readable files before the
    as-of date, with all readable files, and with a file of the as-of date itself."""
    root = _daily_documents(spark, sf_dir, "arrivals-by-day", cut_every)
    raw = read_arrivals(spark, root, DAILY_GLOB).withColumn("filename", _day_of())
    fresh = arrivals.freshness_from_content(raw)
    readable = fresh.where("balance_epoch IS NOT NULL")
    today = F.unix_timestamp(F.lit(AS_OF).cast("timestamp"))
    states = {
        "nothing": readable.where("false"),
        "before": readable.where(F.col("balance_epoch") < today),
        "all": readable,
        "today": spark.range(1).select(today.alias("balance_epoch")),
    }
    judged = [
        arrivals.admit(fresh, stored, f"{AS_OF} 18:00:00").select(
            F.lit(name).alias("stored"), "filename", "n_accounts", "decision"
        )
        for name, stored in states.items()
    ]
    return reduce(DataFrame.unionByName, judged)


def snapshot_admission_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order, in one file for each order date; every tenth day's file is cut short."""
    return _judged_days(spark, sf_dir, 10)


def snapshot_admission_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order, with every second day's file cut short."""
    return _judged_days(spark, sf_dir, 2)


def snapshot_scan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accounts of files that hold one indented document each."""
    root = _daily_documents(spark, sf_dir, "documents", indent=True)
    rows = flatten_accounts(read_snapshots(spark, root, DAILY_GLOB))
    return rows.withColumn("filename", _day_of())


def freshness_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of stored files and whether they are of the as-of day or the day before."""
    orders = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy/MM/dd")
    files = orders.select(
        F.concat(
            F.lit("s3a://bucket/transactions/"), day, F.lit("/"), "o_orderkey",
            F.when(F.col("o_orderkey") % 3 == 0, "Z.json").otherwise(
                F.concat(F.lit("Z_bd"), F.unix_timestamp(F.col("o_orderdate").cast("timestamp")), F.lit(".json"))
            ),
        ).alias("filename")
    )
    named = arrivals.freshness_from_names(files)
    recent = arrivals.stored_recently(named, f"{AS_OF} 18:00:00").select("filename", F.lit(True).alias("recent"))
    return named.join(recent, "filename", "left").select(
        "filename", "balance_epoch", F.coalesce("recent", F.lit(False)).alias("recent")
    )


def freshness_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance dates of real files, one folder for each order date, from their listing.

    A third of the days have no balance date in their name.
    """
    day = F.to_date("o_orderdate")
    epoch = F.unix_timestamp(day.cast("timestamp"))
    named = F.when(F.unix_date(day) % 3 == 0, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("Z.json"))).otherwise(
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("Z_bd"), epoch, F.lit(".json"))
    )
    root = scratch_path(spark, "listing")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string"), named.alias("name"))
    orders.repartition("name").write.partitionBy("name").text(f"{root}/transactions/2001/06/15")
    files = list_files(spark, root, "transactions/*/*/*/*/*.txt")
    # Spark names a file itself, so its folder stands for it.
    files = files.withColumn("filename", F.regexp_extract("filename", "name=([^/]+)/", 1))
    return arrivals.freshness_from_names(files.select("filename").distinct())


# Quality ------------------------------------------------------------------


def _line_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("value")
    )


def quality_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicated(_line_ids(spark, sf_dir), "value")


def quality_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    return quality.orphans(customer, "c_custkey", supplier, "s_suppkey")


def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = Warehouse(spark, sf_dir)
    fact = warehouse.table("fact_transactions")
    merchants = warehouse.table("dim_merchant")
    key = "merchant_category_key"
    return quality.run_checks(
        [
            quality.Check("unique txn_id", quality.duplicated(fact, "txn_id")),
            quality.Check("not_null payee", quality.missing(fact, "payee"), quality.WARN),
            quality.Check("unique line", quality_unique(spark, sf_dir)),
            quality.Check(
                "merchant known", quality.orphans(fact, key, merchants, key), quality.WARN
            ),
            quality.Check(
                "no unknown transactions",
                warehouse.table("rpt_unknown_transactions"),
                quality.WARN,
            ),
        ]
    )


def quality_catalog_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = F.when(F.col("p_size") > 45, "+").otherwise("")
    merchants = table(spark, sf_dir, "part").select(
        F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), mark).alias("token"),
        F.lower("p_type").alias("category"),
        F.col("p_retailprice").alias("amount_min"),
        (F.col("p_size") * 4 + 900).alias("amount_max"),
    )
    references = table(spark, sf_dir, "supplier").select(F.lower("s_name").alias("token"))
    return quality.run_checks(catalog.catalog_checks(merchants, references))


def quality_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines offered as two marts: each way to differ from a contract, with the
    rows that ``conform`` lets through."""
    orders, line = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    income = orders.select(
        F.col("o_custkey").cast("string").alias("account"),
        F.col("o_orderpriority").alias("merchant_category"),
        F.col("o_orderstatus").alias("merchant"),
        F.col("o_totalprice").cast("decimal(13,1)").alias("amount_earned"),
        F.col("o_orderkey").alias("txn_description"),
        "o_orderdate",
    )
    unknown = line.select(
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
        F.col("l_shipdate").cast("timestamp").alias("posted_at_timestamp"),
        F.col("l_returnflag").alias("payee"),
        F.col("l_linestatus").alias("merchant_category"),
        F.lit(None).alias("txn_description"),
    )
    offered = {"rpt_income_detail": income, "rpt_unknown_transactions": unknown}
    passed = conform(unknown, "rpt_unknown_transactions").agg(
        F.lit("rpt_unknown_transactions").alias("table_name"), F.count(F.lit(1)).alias("rows_conformed")
    )
    return drift_report(spark, offered).join(F.broadcast(passed), "table_name", "left")


# Streams ------------------------------------------------------------------


def _overlapping_files(spark: SparkSession, rows: DataFrame, at: str, name: str) -> str:
    """Rows written as files of overlapping stretches of time.

    Each year's file repeats the second half of the year before, as successive
    pulls repeat the days they share.
    """
    month = F.month(at)
    year = F.year(at)
    pulls = F.when(month > 6, F.array(year, year + 1)).otherwise(F.array(year))
    path = scratch_path(spark, name)
    rows.withColumn("pull", F.explode(pulls)).write.partitionBy("pull").parquet(path)
    return path


def _stream_of(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    return reader.option("maxFilesPerTrigger", 32).parquet(path)


def _ledger_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    rows = ledger(spark, sf_dir)
    path = _overlapping_files(spark, rows, "posted_at_timestamp", "pulls")
    return _stream_of(spark, path, rows.schema)


def stream_latest_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact latest-wins per id over overlapping pulls."""
    stream = _ledger_stream(spark, sf_dir)
    store = transaction_store(scratch_path(spark, "transaction-store"))
    absorb_available(stream, store, scratch_path(spark, "checkpoint"))
    store.compact(spark, fan_in=2)
    return star.as_fact(store.current(spark), LOADED_AT)


def stream_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One store fed by two streams, one of them before and one after a merge."""
    configure(spark)
    store = transaction_store(scratch_path(spark, "transaction-store"))
    rows = ledger(spark, sf_dir)
    late = F.year("posted_at_timestamp") >= 1996
    for part in (rows.where(late), rows.where(~late)):
        path = _overlapping_files(spark, part, "posted_at_timestamp", "pulls")
        absorb_available(_stream_of(spark, path, part.schema), store, scratch_path(spark, "checkpoint"))
        store.compact(spark, fan_in=2)
    return star.as_fact(store.current(spark), LOADED_AT)


def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-seen ids over overlapping pulls that arrive in any order."""
    stream = _ledger_stream(spark, sf_dir)
    path = scratch_path(spark, "first-seen")
    append_available(stream, path, scratch_path(spark, "checkpoint"))
    return first_seen(spark, path).select("txn_id")


def stream_late_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-seen ids when all pulls before 1995 arrive years late, as another stream."""
    configure(spark)
    path = scratch_path(spark, "first-seen")
    rows = ledger(spark, sf_dir)
    old = F.year("posted_at_timestamp") < 1995
    for part in (rows.where(~old), rows.where(old)):
        files = _overlapping_files(spark, part, "posted_at_timestamp", "pulls")
        append_available(_stream_of(spark, files, part.schema), path, scratch_path(spark, "checkpoint"))
    return first_seen(spark, path).select("txn_id")


def stream_latest_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest balance per account name over overlapping pulls."""
    configure(spark)
    rows = flatten_accounts(account_snapshots(spark, sf_dir))
    path = _overlapping_files(spark, rows, "balance_as_of_timestamp", "balances")
    store = account_store(scratch_path(spark, "account-store"))
    stream = _stream_of(spark, path, rows.schema)
    absorb_available(stream, store, scratch_path(spark, "checkpoint"))
    return store.current(spark)


def stream_json_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest balances from streamed files of which every tenth is cut short, and the
    files that could not be read."""
    configure(spark)
    root = _daily_documents(spark, sf_dir, "json-stream", 10)
    store = account_store(scratch_path(spark, "account-store"))
    letters = scratch_path(spark, "dead-letters")
    documents = stream_documents(spark, root, DAILY_GLOB)
    absorb_documents(documents, store, flatten_accounts, letters, scratch_path(spark, "checkpoint"))
    accounts = store.current(spark).withColumn("reason", F.lit(None).cast("string"))
    dead = read_dead_letters(spark, letters)
    return accounts.unionByName(dead, allowMissingColumns=True).withColumn("filename", _day_of())


# The whole build -----------------------------------------------------------


_builds: dict[tuple[str, str], str] = {}


def _whole_build(spark: SparkSession, sf_dir: str) -> str:
    """Every table from nested documents, with the pay rates and catalog as CSV.

    The documents of a month are one file, so rows of one id and time share their file and
    the other columns choose among them, however the rows were dealt before.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _builds:
        return _builds[key]
    configure(spark)
    root = scratch_path(spark, "build")
    posted = F.col("posted_at_timestamp")
    pull = {"year": F.year(posted), "month": F.month(posted), "day": F.lit(1)}
    # Flat rows are shuffled, and nested where they are written.
    rows = ledger(spark, sf_dir).drop("filename").withColumns(pull).repartition(*pull)
    raw = documents_of(rows).select("accounts", *pull)
    writer = raw.write.partitionBy(*pull).option("compression", "gzip")
    writer.json(f"{root}/transactions")
    documents = read_snapshots(spark, root, f"{SNAPSHOT_GLOB}.gz", one_document_per_file=False)
    pay = scratch_path(spark, "pay-csv")
    testbed_pay(spark).write.option("header", True).csv(pay)
    patterns = scratch_path(spark, "patterns-csv")
    testbed_catalog(spark).write.option("header", True).option("escape", '"').csv(patterns)
    first, last = table(spark, sf_dir, "lineitem").agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
    build_all(
        spark,
        root,
        regex_csv=patterns,
        payrate_csv=pay,
        as_of=AS_OF,
        calendar=(str(first)[:10], str(last + dt.timedelta(days=1))[:10]),
        snapshots=documents,
    )
    _builds[key] = root
    return root


def _of_build(name: str, *dropped: str) -> Query:
    return lambda spark, sf_dir: read_table(spark, _whole_build(spark, sf_dir), name).drop(*dropped)


_refreshed: dict[tuple[str, str], str] = {}


def _refreshed_build(spark: SparkSession, sf_dir: str) -> str:
    """A build without the rows before 1995 and without every seventh order, then a
    refresh with these and with all rows of 1996 once more."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _refreshed:
        return _refreshed[key]
    configure(spark)
    root = scratch_path(spark, "refreshed")
    # Read by the build and by the refresh, so stored once.
    path = scratch_path(spark, "ledger")
    rows = ledger(spark, sf_dir).withColumn("filename", F.lit("ledger"))
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    order = F.split_part("txn_id", F.lit("-"), F.lit(1)).cast("long")
    year = F.year("posted_at_timestamp")
    late = (year < 1995) | (order % 7 == 0)
    accounts = flatten_accounts(account_snapshots(spark, sf_dir))
    pay, patterns = scratch_path(spark, "pay-csv"), scratch_path(spark, "patterns-csv")
    testbed_pay(spark).write.option("header", True).csv(pay)
    testbed_catalog(spark).write.option("header", True).option("escape", '"').csv(patterns)
    first, last = table(spark, sf_dir, "lineitem").agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
    build_all(
        spark,
        root,
        regex_csv=patterns,
        payrate_csv=pay,
        as_of=AS_OF,
        calendar=(str(first)[:10], str(last + dt.timedelta(days=1))[:10]),
        stores=(rows.where(~late), accounts),
    )
    refresh_all(spark, root, rows.where(late | (year == 1996)), AS_OF)
    _refreshed[key] = root
    return root


def _of_refresh(name: str, *dropped: str) -> Query:
    return lambda spark, sf_dir: read_table(spark, _refreshed_build(spark, sf_dir), name).drop(*dropped)


# Registry -----------------------------------------------------------------

FACT, MERCHANT = "fact_transactions", "dim_merchant"
EXPENSES, INCOME = "rpt_expenses_detail", "rpt_income_detail"
SAVINGS, OVERUNDER = "rpt_monthly_savings", "rpt_daily_overunder"
ACCOUNTS = "dim_accounts"


def _calendar_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Warehouse(spark, sf_dir).calendar(corrected=True)


def _null_checks(fact: DataFrame) -> DataFrame:
    severities = {"txn_id": quality.ERROR, "payee": quality.WARN, "amount": quality.ERROR}
    return quality.null_checks("fact", fact, severities)


def _cc_spend_with_total(expenses: DataFrame) -> DataFrame:
    return with_total_row(reports.rows_cc_spend(expenses), ["amount_spent"])


def _positions(build: Callable[..., DataFrame], *tables: str, **options: object) -> Query:
    """A sorted listing with the place of each row."""
    listing = _report(build, *tables, **options)
    return lambda spark, sf_dir: numbered(listing(spark, sf_dir), "position")


QUERIES: dict[str, Query] = {
    # Star schema
    "fact_dedup": _built(FACT),
    "fact_from_snapshots": fact_from_snapshots,
    "accounts_latest": _built(ACCOUNTS),
    "dim_merchant": _built(MERCHANT),
    "dim_date": _built("dim_date"),
    "dim_date_corrected": _calendar_corrected,
    "daily_pay": _built("fact_daily_pay"),
    # Marts
    "expenses_detail": _built(EXPENSES),
    "income_detail": _built(INCOME),
    "unknown_transactions": _built("rpt_unknown_transactions"),
    "daily_overunder": _built(OVERUNDER),
    "monthly_savings": _built(SAVINGS),
    "monthly_savings_corrected": _report(
        marts.rpt_monthly_savings, EXPENSES, INCOME, corrected=True
    ),
    "mom_performance": _built("rpt_mom_performance"),
    "mom_performance_corrected": _report(
        marts.rpt_mom_performance, FACT, OVERUNDER, as_of=AS_OF, corrected=True
    ),
    "top_expenses": _built("rpt_top_expenses"),
    "top_expenses_corrected": _report(marts.rpt_top_expenses, MERCHANT, corrected=True),
    "positions_all_expenses": _positions(reports.rows_all_expenses, EXPENSES),
    "positions_expense_categories": _positions(reports.flt_chart_col_expenses, EXPENSES),
    "positions_top_expenses": _positions(reports.top_expenses_ranked, "rpt_top_expenses"),
    "top_expenses_ranked": _report(reports.top_expenses_ranked, "rpt_top_expenses"),
    # Report queries
    "q01_total_assets_minus_mortgage": _report(reports.total_assets_minus_mortgage, ACCOUNTS),
    "q02_total_cc_debt": _report(reports.total_cc_debt, ACCOUNTS),
    "q03_total_checking": _report(reports.total_checking, ACCOUNTS),
    "q04_total_mortgage": _report(reports.total_mortgage, ACCOUNTS),
    "q05_total_savings1": _report(reports.total_savings1, ACCOUNTS),
    "q06_total_savings2": _report(reports.total_savings2, ACCOUNTS),
    "q07_chart_coe_expenses_detail": _report(
        reports.chart_coe_expenses_detail, EXPENSES, as_of=AS_OF
    ),
    "q08_chart_daily_overunder": _report(reports.chart_daily_overunder, OVERUNDER, EXPENSES),
    "q09_chart_monthly_savings": _report(reports.chart_monthly_savings, SAVINGS),
    "q10_rows_all_expenses": _report(reports.rows_all_expenses, EXPENSES),
    "q11_rows_cc_interest_payments": _report(
        reports.rows_cc_interest_payments, EXPENSES, as_of=AS_OF
    ),
    "q12_rows_income": _report(reports.rows_income, INCOME, as_of=AS_OF),
    "q13_rows_mortgage_payment": _report(
        reports.rows_mortgage_payment, EXPENSES, as_of=AS_OF
    ),
    "q14_rows_monthly_savings": _report(reports.rows_monthly_savings, SAVINGS),
    "q15_rows_cc_spend": _report(reports.rows_cc_spend, EXPENSES),
    "q16_col_dollar_bounds": _report(reports.col_dollar_bounds, EXPENSES),
    "q17_flt_chart_col_expenses": _report(
        reports.flt_chart_col_expenses,
        EXPENSES,
        dollar_cap="600.50",
        categories=["cost-of-living", "debt", "payments"],
        lower="1996-02-29",
        upper="not a date",
    ),
    "q18_unique_merch_cats": _report(reports.unique_merch_cats, EXPENSES),
    "q19_expenses_detail_bounds": _report(reports.expenses_detail_bounds, EXPENSES),
    "q20_flt_rows_all_expenses": _report(
        reports.flt_rows_all_expenses,
        EXPENSES,
        lower="1997-01-15",
        upper="1999-12-31",
        categories=["going-out", "debt"],
    ),
    "q21_savings_bounds": _report(reports.savings_bounds, SAVINGS),
    "q22_total_saved": _report(reports.total_saved, SAVINGS),
    "q23_savings_cutoff_month": _report(reports.savings_cutoff_month, SAVINGS, months=14),
    "q24_unique_inc_types": _report(reports.unique_inc_types, INCOME, as_of=AS_OF),
    "q25_flt_rows_all_income": _report(
        reports.flt_rows_all_income, INCOME, types=["payments | paycheck"], as_of=AS_OF
    ),
    "listing_with_total_row": _report(_cc_spend_with_total, EXPENSES),
    # Quality
    "quality_unique": quality_unique,
    "quality_not_null": _report(
        quality.null_counts, FACT, columns=["txn_id", "payee", "amount"]
    ),
    "quality_not_null_checks": _report(_null_checks, FACT),
    "quality_relationships": quality_relationships,
    "quality_checks": quality_checks,
    "quality_category_coverage": _report(quality.category_coverage, MERCHANT),
    "quality_coverage_summary": _report(quality.coverage_summary, MERCHANT, unknown=UNKNOWN),
    "quality_unknown_merchants": _report(
        quality.unknown_merchants, MERCHANT, unknown=UNKNOWN
    ),
    "quality_catalog_rules": quality_catalog_rules,
    "quality_contract": quality_contract,
    # The whole build
    "categorize_large": categorize_large,
    "build_monthly_savings": _of_build("rpt_monthly_savings"),
    "build_fact_transactions": _of_build("fact_transactions", "filename"),
    "build_daily_pay": _of_build("fact_daily_pay"),
    "refresh_fact_transactions": _of_refresh("fact_transactions", "filename"),
    "refresh_dim_merchant": _of_refresh(MERCHANT),
    "refresh_expenses_detail": _of_refresh(EXPENSES),
    "refresh_income_detail": _of_refresh(INCOME),
    "refresh_unknown_transactions": _of_refresh("rpt_unknown_transactions"),
    "refresh_daily_overunder": _of_refresh(OVERUNDER),
    "refresh_monthly_savings": _of_refresh(SAVINGS),
    "refresh_mom_performance": _of_refresh("rpt_mom_performance"),
    "refresh_top_expenses": _of_refresh("rpt_top_expenses"),
    # Catalog, history, arrivals
    "catalog_build": catalog_build,
    "catalog_build_large": catalog_build_large,
    "catalog_csv_scan": catalog_csv_scan,
    "catalog_overlay": catalog_overlay,
    "balance_as_of": balance_as_of,
    "trailing_snapshot": trailing_snapshot,
    "trailing_snapshot_hot": trailing_snapshot_hot,
    "snapshot_scan_fact": snapshot_scan_fact,
    "snapshot_scan_accounts": snapshot_scan_accounts,
    "snapshot_scan_documents": snapshot_scan_documents,
    "snapshot_freshness": snapshot_freshness,
    "snapshot_admission": snapshot_admission,
    "snapshot_admission_unreadable": snapshot_admission_unreadable,
    "snapshot_admission_by_day": snapshot_admission_by_day,
    "freshness_names": freshness_names,
    "freshness_listing": freshness_listing,
    # Streams
    "stream_latest_transactions": stream_latest_transactions,
    "stream_two_checkpoints": stream_two_checkpoints,
    "stream_first_seen": stream_first_seen,
    "stream_json_snapshots": stream_json_snapshots,
    "stream_late_backfill": stream_late_backfill,
    "stream_latest_accounts": stream_latest_accounts,
}


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return comparable(query(spark, sf_dir))

    return run


def queries() -> dict[str, Query]:
    return {name: _registered(query) for name, query in QUERIES.items()}
