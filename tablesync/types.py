"""Column types of a table and how they meet Spark's types.

A table type is plain text such as ``DECIMAL(10,2)`` or ``VARCHAR(20)``; nested types use Spark's own DDL spelling
(``ARRAY<INT>``, ``MAP<INT,STRING>``, ``STRUCT<a: INT>``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F, types as T

MAX_VARCHAR = 1048576  # fixed value: longest VARCHAR a table accepts
STRING_SIZE = 65533  # fixed value: size of STRING in bytes

# fixed values: scalar table types without parameters
SCALARS: dict[str, T.DataType] = {
    "BOOLEAN": T.BooleanType(),
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "LARGEINT": T.StringType(),  # 128 bit, carried as text
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "TEXT": T.StringType(),
    "CHAR": T.StringType(),
    "VARCHAR": T.StringType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "JSON": T.StringType(),
    "JSONB": T.StringType(),
    "BITMAP": T.BinaryType(),
    "HLL": T.BinaryType(),
    "BINARY": T.BinaryType(),
}

# fixed values: which input types a column accepts; a table type that is not listed accepts every input type
ACCEPTED: dict[str, set[str]] = {
    "bigint": {"bigint", "int", "binary"},
    "largeint": {"decimal", "bigint", "int", "binary"},
    "char": {"string"},
    "date": {"date", "string"},
    "datetime": {"timestamp_ntz", "timestamp", "string"},
    "decimal": {"decimal", "bigint", "int", "double", "float"},
    "double": {"double", "bigint", "int"},
    "float": {"float", "int"},
    "int": {"int", "binary"},
    "tinyint": {"tinyint", "int", "binary", "boolean"},
    "smallint": {"smallint", "int", "binary"},
    "varchar": {"string", "array", "map", "struct"},
    "string": {"string", "array", "map", "struct"},
}

# fixed values: source database type -> table type, for types without length rules
SOURCE_TYPES: dict[str, str] = {
    "BIT": "BOOLEAN", "BOOLEAN": "BOOLEAN", "BOOL": "BOOLEAN",
    "TINYINT": "TINYINT",
    "TINYINT UNSIGNED": "SMALLINT", "TINYINT UNSIGNED ZEROFILL": "SMALLINT", "SMALLINT": "SMALLINT",
    "SMALLINT UNSIGNED": "INT", "SMALLINT UNSIGNED ZEROFILL": "INT", "INT": "INT", "MEDIUMINT": "INT", "YEAR": "INT",
    "INT UNSIGNED": "BIGINT", "INT UNSIGNED ZEROFILL": "BIGINT", "MEDIUMINT UNSIGNED": "BIGINT",
    "MEDIUMINT UNSIGNED ZEROFILL": "BIGINT", "BIGINT": "BIGINT",
    "BIGINT UNSIGNED": "LARGEINT", "BIGINT UNSIGNED ZEROFILL": "LARGEINT",
    "FLOAT": "FLOAT", "FLOAT UNSIGNED": "FLOAT", "FLOAT UNSIGNED ZEROFILL": "FLOAT",
    "REAL": "DOUBLE", "REAL UNSIGNED": "DOUBLE", "REAL UNSIGNED ZEROFILL": "DOUBLE",
    "DOUBLE": "DOUBLE", "DOUBLE UNSIGNED": "DOUBLE", "DOUBLE UNSIGNED ZEROFILL": "DOUBLE",
    "DOUBLE PRECISION": "DOUBLE", "DOUBLE PRECISION UNSIGNED": "DOUBLE", "DOUBLE PRECISION UNSIGNED ZEROFILL": "DOUBLE",
    "DATE": "DATE", "DATETIME": "DATETIME", "TIMESTAMP": "DATETIME", "TIME": "STRING",
    "TINYTEXT": "STRING", "TEXT": "STRING", "MEDIUMTEXT": "STRING", "LONGTEXT": "STRING", "ENUM": "STRING",
    "TINYBLOB": "STRING", "BLOB": "STRING", "MEDIUMBLOB": "STRING", "LONGBLOB": "STRING",
    "BINARY": "STRING", "VARBINARY": "STRING",
    "JSON": "JSON",
}

# fixed values: source types that become DECIMAL(length, scale)
SOURCE_DECIMALS = ("NUMERIC", "FIXED", "DECIMAL")

_PARAM = re.compile(r"^\s*([A-Za-z0-9_ ]+?)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*$")


def split_type(text: str) -> tuple[str, int | None, int | None]:
    """``"DECIMAL(10, 2)"`` -> ``("DECIMAL", 10, 2)``; nested types come back whole."""
    m = _PARAM.match(text)
    if not m:
        return text.strip().upper().split("<")[0], None, None
    name, a, b = m.groups()
    return " ".join(name.upper().split()), int(a) if a else None, int(b) if b else None


def spark_type(text: str) -> T.DataType:
    """Spark type that holds a column of the table type ``text``."""
    if "<" in text:
        return T.DataType.fromDDL(text)
    name, precision, scale = split_type(text)
    if name in ("DECIMAL", "DECIMALV2", "DECIMAL32", "DECIMAL64", "DECIMAL128"):
        if precision is None:
            raise ValueError("DECIMAL needs precision and scale")
        return T.DecimalType(precision, scale or 0)
    if name not in SCALARS:
        raise ValueError(f"unsupported table type {text}")
    return SCALARS[name]


def table_type(dtype: T.DataType) -> str:
    """Table type text for a Spark type (used when a table is created from a DataFrame schema)."""
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    if isinstance(dtype, T.CharType):
        return f"CHAR({dtype.length})"
    if isinstance(dtype, T.VarcharType):
        return f"VARCHAR({min(dtype.length, MAX_VARCHAR)})"
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return dtype.simpleString()
    names = {
        "boolean": "BOOLEAN", "tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INT", "bigint": "BIGINT",
        "float": "FLOAT", "double": "DOUBLE", "string": "STRING", "date": "DATE", "timestamp": "DATETIME",
        "timestamp_ntz": "DATETIME", "variant": "JSON", "binary": "BINARY",
    }
    name = dtype.simpleString()
    if name not in names:
        raise ValueError(f"no table type for {name}")
    return names[name]


def reported_type(name: str, size: int | None = None, digits: int | None = None) -> T.DataType:
    """Spark type for a column as database metadata reports it.

    Metadata calls a BOOLEAN column ``tinyint`` with no size, so the size tells the two apart.
    """
    upper = name.upper()
    if upper == "TINYINT":
        return T.BooleanType() if size is None else T.ByteType()
    if upper in ("CHAR", "VARCHAR"):
        if size is None:
            raise ValueError(f"{upper} needs a size")
        return T.CharType(size) if upper == "CHAR" else T.VarcharType(size)
    if upper == "DECIMAL":
        if size is None or digits is None:
            raise ValueError("DECIMAL needs precision and scale")
        return T.DecimalType(size, digits)
    if upper in ("BITMAP", "HLL", "BINARY") or upper not in SCALARS:
        raise ValueError(f"table type {name} cannot be mapped")
    return SCALARS[upper]


def accepts(column_type: str, dtype: T.DataType) -> bool:
    """Whether a column of table type ``column_type`` takes input of Spark type ``dtype``."""
    allowed = ACCEPTED.get(split_type(column_type)[0].lower())
    given = "string" if isinstance(dtype, (T.CharType, T.VarcharType)) else dtype.typeName()
    given = {"long": "bigint", "integer": "int", "short": "smallint", "byte": "tinyint"}.get(given, given)
    return allowed is None or given in allowed


def source_type(name: str, length: int | None = None, scale: int | None = None) -> str:
    """Table type for one source database column type; unknown types are an error."""
    upper = " ".join(name.upper().split())
    if upper in SOURCE_TYPES:
        return SOURCE_TYPES[upper]
    if upper.removesuffix(" ZEROFILL").removesuffix(" UNSIGNED") in SOURCE_DECIMALS:
        return f"DECIMAL({length},{max(scale or 0, 0)})" if length is not None and length <= 38 else "STRING"
    if upper in ("CHAR", "VARCHAR"):
        if length is None:
            raise ValueError(f"{upper} needs a length")
        if upper == "CHAR":
            return f"CHAR({length})"
        return "STRING" if length * 3 > STRING_SIZE else f"VARCHAR({length * 3})"
    raise ValueError(f"unsupported source type {name}")


def source_type_column(name: Column, length: Column, scale: Column) -> Column:
    """The same mapping as :func:`source_type` over rows of column metadata; unknown types raise at run time."""
    upper = F.upper(F.regexp_replace(F.trim(name), r"\s+", " "))
    base = F.regexp_replace(upper, r"( UNSIGNED)?( ZEROFILL)?$", "")
    plain = F.create_map(*[F.lit(x) for kv in SOURCE_TYPES.items() for x in kv])
    decimal = F.when(
        length <= 38, F.format_string("DECIMAL(%d,%d)", length, F.greatest(F.coalesce(scale, F.lit(0)), F.lit(0)))
    ).otherwise("STRING")
    no_length = F.raise_error(F.concat(upper, F.lit(" needs a length"))).cast("string")
    char = F.when(length.isNull(), no_length).otherwise(F.format_string("CHAR(%d)", length))
    varchar = (
        F.when(length.isNull(), no_length)
        .when(length * 3 > STRING_SIZE, "STRING")
        .otherwise(F.format_string("VARCHAR(%d)", length * 3))
    )
    return (
        F.when(base.isin(*SOURCE_DECIMALS), decimal)
        .when(upper == "CHAR", char)
        .when(upper == "VARCHAR", varchar)
        .when(F.map_contains_key(plain, upper), F.try_element_at(plain, upper))
        .otherwise(F.raise_error(F.concat(F.lit("unsupported source type "), name)).cast("string"))
    )
