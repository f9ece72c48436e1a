"""Declared source types: what a type name says, and the portable Spark type it maps to."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

SOURCE_TYPE = "source_type"  # StructField metadata key

# Fixed value: widest numeric(p,s) kept as an exact decimal in decimal mode.
MAX_DECIMAL_PRECISION = 16

# Type names the source database prints, by kind.
KIND_OF = {
    "bool": "bool",
    "boolean": "bool",
    "int2": "int32",
    "smallint": "int32",
    "int": "int32",
    "int4": "int32",
    "integer": "int32",
    "int8": "int64",
    "bigint": "int64",
    "float4": "float32",
    "real": "float32",
    "float8": "float64",
    "double precision": "float64",
    "numeric": "numeric",
    "decimal": "numeric",
    "date": "date",
    "time": "time",
    "time without time zone": "time",
    "timestamp": "timestamp",
    "timestamp without time zone": "timestamp",
    "timestamptz": "timestamptz",
    "timestamp with time zone": "timestamptz",
    "bpchar": "char",
    "char": "char",
    "character": "char",
}

SPARK_TYPE = {
    "bool": T.BooleanType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "numeric": T.DoubleType(),
    "date": T.DateType(),
    "time": T.TimeType(6),
    "timestamp": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(),
    "char": T.StringType(),
    "text": T.StringType(),
}

# The short labels a reader reports for a kind.
READER_LABEL = {
    "bool": "bool",
    "int32": "int",
    "int64": "int",
    "float32": "float32",
    "float64": "float",
    "numeric": "float",
    "date": "date",
    "time": "time",
    "timestamp": "timestamp",
    "timestamptz": "timestamptz",
    "char": "string",
    "text": "string",
}

# name, optional (arguments), optional words after them, as in `timestamp(3) with time zone`
TYPE_NAME = re.compile(r"\s*([^()\[\]]+?)\s*(?:\(([^()]*)\)\s*([^()\[\]]*?)\s*)?")


@dataclass(frozen=True)
class Declared:
    """One declared type."""

    name: str
    kind: str
    precision: int | None = None
    scale: int | None = None

    @property
    def exact(self) -> bool:
        """Whether decimal mode keeps this numeric exactly."""
        return (
            self.kind == "numeric"
            and self.precision is not None
            and self.precision <= MAX_DECIMAL_PRECISION
            and 0 <= self.scale <= self.precision
        )

    def spark_type(self, decimal: bool = False) -> T.DataType:
        if decimal and self.exact:
            return T.DecimalType(self.precision, self.scale)
        return SPARK_TYPE[self.kind]


def declared(name: str) -> Declared:
    """Read a type name; anything not mapped natively (arrays, json, uuid, ...) is text."""
    found = TYPE_NAME.fullmatch(name)
    if found is None:
        return Declared(name, "text")
    head, arguments, tail = found.groups()
    kind = KIND_OF.get(" ".join(f"{head} {tail or ''}".lower().split()), "text")
    if kind != "numeric" or not arguments:
        return Declared(name, kind)
    precision, _, scale = arguments.partition(",")
    return Declared(name, kind, int(precision), int(scale or 0))


def declared_for(dtype: T.DataType) -> str:
    """The declared type name a native Spark column stands for."""
    if isinstance(dtype, T.DecimalType):
        return f"numeric({dtype.precision},{dtype.scale})"
    if isinstance(dtype, T.ArrayType):
        return declared_for(dtype.elementType) + "[]"
    names = {
        T.BooleanType: "boolean",
        T.ByteType: "smallint",
        T.ShortType: "smallint",
        T.IntegerType: "integer",
        T.LongType: "bigint",
        T.FloatType: "real",
        T.DoubleType: "double precision",
        T.DateType: "date",
        T.TimeType: "time without time zone",
        T.TimestampNTZType: "timestamp without time zone",
        T.TimestampType: "timestamp with time zone",
        T.MapType: "jsonb",
        T.StructType: "jsonb",
    }
    return names.get(type(dtype), "text")


def source_type(field: T.StructField) -> str:
    """The declared type recorded on a field, else the one its Spark type stands for."""
    return field.metadata.get(SOURCE_TYPE) or declared_for(field.dataType)


Types = Mapping[str, str] | Iterable[tuple[str, str]] | None


def declared_columns(df: DataFrame, types: Types) -> list[Declared]:
    """One `Declared` per column of df: by name from a mapping, by position from pairs."""
    if types is None or isinstance(types, Mapping):
        by_name = dict(types or {})
        unknown = by_name.keys() - set(df.columns)
        if unknown:
            raise ValueError(f"declared types for columns that do not exist: {sorted(unknown)}")
        return [declared(by_name.get(f.name) or source_type(f)) for f in df.schema]
    pairs = list(types)
    if len(pairs) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns, {len(pairs)} declared types")
    return [declared(name) for _, name in pairs]


def with_numeric_type(catalog: DataFrame, typmod: str = "atttypmod") -> DataFrame:
    """Add `precision` and `scale` decoded from a numeric type modifier; NULL if unconstrained.

    A modifier is 4 + (precision << 16 | scale), the scale an 11-bit signed number.
    """
    bits = F.col(typmod) - 4
    low = bits.bitwiseAND(F.lit(0x7FF))
    constrained = F.col(typmod) >= 4
    return catalog.withColumns(
        {
            "precision": F.when(constrained, F.shiftright(bits, 16).bitwiseAND(F.lit(0xFFFF))),
            "scale": F.when(constrained, F.when(low >= 1024, low - 2048).otherwise(low)),
        }
    )


def expected_kinds(types: DataFrame, decimal: bool = False) -> DataFrame:
    """Add `kind`, the label a reader should report, to rows holding a declared `type`."""
    bare = r"trim(regexp_replace(lower(type), r'\s*\([^)]*\)', ''))"
    arguments = r"r'\(\s*(\d+)\s*(,\s*(-?\d+)\s*)?\)'"
    precision = f"CAST(nullif(regexp_extract(type, {arguments}, 1), '') AS INT)"
    scale = f"CAST(nullif(regexp_extract(type, {arguments}, 3), '') AS INT)"
    exact = (
        f"{decimal} AND {bare} IN ('numeric', 'decimal') AND {precision} <= {MAX_DECIMAL_PRECISION}"
        f" AND coalesce({scale}, 0) BETWEEN 0 AND {precision}"
    )
    labels = "".join(f" WHEN {bare} = '{n}' THEN '{READER_LABEL[k]}'" for n, k in KIND_OF.items())
    return types.selectExpr(
        "*", f"CASE WHEN {exact} THEN 'decimal'{labels} ELSE 'string' END AS kind"
    )


def reader_label(dtype: T.DataType) -> str:
    """The label a reader reports for a Spark type."""
    if isinstance(dtype, T.DecimalType):
        return "decimal"
    if isinstance(dtype, T.StringType):
        return "string"
    if isinstance(dtype, T.IntegralType):
        return "int"
    name = declared(declared_for(dtype))
    return READER_LABEL[name.kind] if name.kind != "text" else "other"


def actual_kinds(df: DataFrame) -> DataFrame:
    """One row per column of df: ordinal, name, type, kind. Reads the schema only."""
    rows = [
        (i, f.name, f.dataType.simpleString(), reader_label(f.dataType))
        for i, f in enumerate(df.schema, start=1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, name string, type string, kind string"
    )


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def with_types(df: DataFrame, type_names: Iterable[str]) -> DataFrame:
    """The same relation, with a declared type recorded on each column (names are distinct)."""
    fields = [
        T.StructField(field.name, field.dataType, field.nullable, {SOURCE_TYPE: type_name})
        for field, type_name in zip(df.schema, type_names)
    ]
    return df.to(T.StructType(fields))
