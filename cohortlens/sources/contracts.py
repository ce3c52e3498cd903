"""What the input tables must look like.

Each table is declared with the columns that the products read and their kinds. A
kind is looser than a type: whole numbers may be of any width, and amounts decimal
or floating, as sources differ in that; a text in place of a date is an error. The
check looks at schemas only, and one error names everything that is wrong."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

WHOLE, AMOUNT, TEXT, DAY = "a whole number", "a number", "a text", "a date or time"
_KINDS = {
    WHOLE: (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    AMOUNT: (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType),
    TEXT: (T.StringType, T.CharType, T.VarcharType),
    DAY: (T.DateType, T.TimestampType, T.TimestampNTZType),
}

#: Columns by table, and their kinds.
CONTRACTS: dict[str, dict[str, str]] = {
    "nation": {"n_nationkey": WHOLE, "n_name": TEXT},
    "customer": {"c_custkey": WHOLE, "c_name": TEXT, "c_nationkey": WHOLE, "c_mktsegment": TEXT, "c_acctbal": AMOUNT},
    "supplier": {"s_suppkey": WHOLE, "s_name": TEXT, "s_nationkey": WHOLE},
    "part": {"p_partkey": WHOLE, "p_name": TEXT, "p_brand": TEXT, "p_type": TEXT, "p_size": WHOLE, "p_retailprice": AMOUNT},
    "orders": {"o_orderkey": WHOLE, "o_custkey": WHOLE, "o_orderstatus": TEXT, "o_totalprice": AMOUNT, "o_orderdate": DAY,
               "o_orderpriority": TEXT},
    "lineitem": {"l_orderkey": WHOLE, "l_partkey": WHOLE, "l_suppkey": WHOLE, "l_linenumber": WHOLE, "l_quantity": AMOUNT,
                 "l_extendedprice": AMOUNT, "l_discount": AMOUNT, "l_tax": AMOUNT, "l_returnflag": TEXT, "l_linestatus": TEXT,
                 "l_shipdate": DAY},
    "events": {"event_id": WHOLE, "user_id": WHOLE, "event_type": TEXT, "props": TEXT},
}


class ContractError(ValueError):
    """Columns of an input that are missing or of another kind."""


def violations(name: str, schema: T.StructType) -> list[str]:
    """What is wrong with a table's schema, column by column."""
    found = {f.name: f.dataType for f in schema.fields}
    out = []
    for column, kind in CONTRACTS.get(name, {}).items():
        if column not in found:
            out.append(f"{column} is missing")
        elif not isinstance(found[column], _KINDS[kind]):
            out.append(f"{column} is {found[column].simpleString()}, not {kind}")
    return out


def checked(name: str, df: DataFrame) -> DataFrame:
    """``df``, if it keeps the contract of table ``name``."""
    wrong = violations(name, df.schema)
    if wrong:
        raise ContractError(f"table {name}: {'; '.join(wrong)}")
    return df
