"""Build and check the regex catalog from a merchant table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passbook.operators.contract import enforce_contract
from passbook.operators.quality import ERROR, WARN, Check, duplicated, orphans

DEFAULT_PRIORITY = 10

# The category taxonomy and the characters a token may not hold.
KNOWN_CATEGORIES = (
    "cost-of-living",
    "going-out",
    "vice",
    "entertainment",
    "discretional",
    "subscription",
    "home-goods",
    "pet-care",
    "travel",
    "debt",
    "fees",
    "payments",
    "transfers",
)
REGEX_METACHARACTERS = r"[()\[\]{}+*?\\^$|]"


def _wrapped(body: Column) -> Column:
    return F.concat(F.lit("^.*("), body, F.lit(").*$"))


def build_catalog(merchants: DataFrame, structural: DataFrame | None = None) -> DataFrame:
    """One pattern per category and subcategory from its merchants' tokens.

    ``merchants`` has category, subcategory, token and priority (NULL means 10);
    ``structural`` has category, subcategory, regex and priority.  Tokens are
    made distinct before they are gathered into the one row their group is.  A
    NULL category or subcategory is a group like any other.
    """
    group = ["category", "subcategory"]
    tokens = merchants.groupBy(*group, "token").agg(
        F.min(F.coalesce("priority", F.lit(DEFAULT_PRIORITY))).alias("priority")
    )
    rows = tokens.groupBy(*group).agg(
        F.array_join(F.array_sort(F.collect_list("token")), "|").alias("regex"),
        F.min("priority").alias("priority"),
    )
    if structural is not None:
        rows = rows.unionByName(
            structural.select("category", "subcategory", "regex", "priority")
        )
    catalog = rows.select(
        F.col("category").alias("merchant_category"),
        F.col("subcategory").alias("merchant_subcategory"),
        _wrapped(F.col("regex")).alias("regex_match_pat"),
        F.col("priority").cast("int").alias("match_priority"),
    )
    return enforce_contract(catalog, "map_merchant_category_regex").orderBy(
        "match_priority", "merchant_category", "merchant_subcategory"
    )


def metacharacter_tokens(merchants: DataFrame) -> DataFrame:
    """Tokens that would corrupt the pattern they are joined into."""
    return merchants.where(F.col("token").rlike(REGEX_METACHARACTERS))


def outside_taxonomy(
    merchants: DataFrame, known: tuple[str, ...] = KNOWN_CATEGORIES
) -> DataFrame:
    return merchants.where(~F.col("category").isin(*known))


def inverted_ranges(merchants: DataFrame) -> DataFrame:
    return merchants.where(F.col("amount_min") > F.col("amount_max"))


def catalog_checks(merchants: DataFrame, references: DataFrame) -> list[Check]:
    """Rules for a merchant table and the tokens that other tables refer to."""
    return [
        Check("duplicate_token", duplicated(merchants, "token"), WARN),
        Check("token_with_metacharacter", metacharacter_tokens(merchants), ERROR),
        Check("category_outside_taxonomy", outside_taxonomy(merchants), WARN),
        Check("amount_min_above_max", inverted_ranges(merchants), ERROR),
        Check("dangling_reference", orphans(references, "token", merchants, "token"), ERROR),
    ]
