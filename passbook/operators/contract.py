"""Schema contracts at table boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from passbook.schemas import CONTRACTS

DIFFERENCE = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("difference", T.StringType()),
        T.StructField("found", T.StringType()),
        T.StructField("wanted", T.StringType()),
        T.StructField("mends_itself", T.BooleanType()),
    ]
)

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Decimal digits that hold every value of a whole-number type.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


class ContractError(ValueError):
    """A table's columns differ from its contract."""


def contract_problems(df: DataFrame, contract: T.StructType) -> list[str]:
    found = {field.name: field.dataType for field in df.schema}
    wanted = {field.name: field.dataType for field in contract}
    problems = [f"missing column {name}" for name in wanted if name not in found]
    problems += [f"unexpected column {name}" for name in found if name not in wanted]
    problems += [
        f"column {name} is {found[name].simpleString()}, not {dtype.simpleString()}"
        for name, dtype in wanted.items()
        if name in found and found[name] != dtype
    ]
    return problems


def enforce_contract(df: DataFrame, table: str) -> DataFrame:
    """Raise on any difference in names or types; fix the column order."""
    contract = CONTRACTS[table]
    problems = contract_problems(df, contract)
    if problems:
        raise ContractError(f"{table}: " + "; ".join(problems))
    return df.select(*contract.fieldNames())


def widens(found: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of ``found`` is one of ``wanted``, so that a cast loses nothing."""
    if found == wanted or isinstance(found, T.NullType):
        return True
    if isinstance(wanted, T.DecimalType):
        if isinstance(found, T.DecimalType):
            whole = found.precision - found.scale <= wanted.precision - wanted.scale
            return whole and found.scale <= wanted.scale
        return DIGITS.get(type(found), 99) <= wanted.precision - wanted.scale
    if isinstance(found, WHOLE) and isinstance(wanted, WHOLE):
        return WHOLE.index(type(found)) <= WHOLE.index(type(wanted))
    if isinstance(found, T.FloatType) or isinstance(found, WHOLE[:3]):
        return isinstance(wanted, T.DoubleType)
    if isinstance(found, T.CharType | T.VarcharType):
        return isinstance(wanted, T.StringType)
    return False


def contract_drift(df: DataFrame, table: str) -> list[tuple]:
    """Rows of ``DIFFERENCE``: each column that differs from the contract, and how.

    ``order`` is told of columns that are right but for their place among the columns that
    both sides have.  ``mends_itself`` tells whether ``conform`` brings the column in line.
    """
    found = {field.name: field.dataType for field in df.schema}
    wanted = {field.name: field.dataType for field in CONTRACTS[table]}
    text = lambda dtype: dtype.simpleString()
    rows = [(table, n, "missing", None, text(t), False) for n, t in wanted.items() if n not in found]
    rows += [(table, n, "extra", text(t), None, False) for n, t in found.items() if n not in wanted]
    both = [n for n in found if n in wanted]
    places = {n: at for at, n in enumerate(n for n in wanted if n in found)}
    for at, name in enumerate(both):
        if found[name] != wanted[name]:
            mends = widens(found[name], wanted[name])
            rows.append((table, name, "type", text(found[name]), text(wanted[name]), mends))
        elif places[name] != at:
            rows.append((table, name, "order", str(at), str(places[name]), True))
    return rows


def drift_report(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """The differences of several tables, read from their schemas alone."""
    rows = [row for table, df in tables.items() for row in contract_drift(df, table)]
    return spark.createDataFrame(rows, DIFFERENCE)


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table under its contract where order and lossless casts do it, else an error."""
    lasting = [row for row in contract_drift(df, table) if not row[5]]
    if lasting:
        problems = [f"{kind} column {name}" for _, name, kind, *_ in lasting]
        raise ContractError(f"{table}: " + "; ".join(problems))
    columns = [df[field.name].cast(field.dataType).alias(field.name) for field in CONTRACTS[table]]
    return enforce_contract(df.select(*columns), table)
