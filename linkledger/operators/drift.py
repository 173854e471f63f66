"""Payload drift: what landed items have that the schema doesn't read, or has under another type.

Flattening drops unknown fields silently. Here the items are kept as VARIANT and their schemas merged by Spark, per kind,
combined before the shuffle; the merged schemas, one text a kind, are then compared with :data:`linkledger.schemas.ITEM_DDL`.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkledger.functions import scalars as X
from linkledger.schemas import ITEM_DDL
from linkledger.sources import payloads as P

_RESULT = T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "path", "found", "expected")])


def item_schemas(docs: DataFrame) -> DataFrame:
    """Of each kind of item the merged ``schema`` of all its items, and their number. Items that aren't objects are left out."""
    items = P.raw_items(docs).selectExpr("try_parse_json(item) AS v").filter("v IS NOT NULL")
    kind = X.lower_or_unknown("try_variant_get(v, '$.type', 'string')")
    return items.selectExpr(f"{kind} AS kind", "v").groupBy("kind").agg(
        F.schema_of_variant_agg("v").alias("schema"), F.count(F.lit(1)).alias("items")
    )


def _fields(found: T.DataType, expected: T.DataType | None, path: str):
    """(path, found, expected) of everything below that isn't read as it is."""
    if isinstance(found, T.ArrayType):
        inner = expected.elementType if isinstance(expected, T.ArrayType) else expected if isinstance(expected, T.VariantType) else None
        if expected is not None and inner is None:
            yield path, found, expected
        else:
            yield from _fields(found.elementType, inner, f"{path}[]")
    elif isinstance(found, T.StructType):
        if expected is not None and not isinstance(expected, (T.StructType, T.VariantType)):
            yield path, found, expected
        elif not isinstance(expected, T.VariantType):
            known = {f.name: f.dataType for f in expected.fields} if expected else {}
            for f in found.fields:
                yield from _fields(f.dataType, known.get(f.name), f"{path}.{f.name}" if path else f.name)
    elif expected is None:
        yield path, found, None
    elif isinstance(expected, (T.StructType, T.ArrayType)) and not isinstance(found, T.NullType):
        yield path, found, expected


def _type(text: str) -> T.DataType:
    """A merged schema as a type; values of several types are VARIANT, those that are always null VOID."""
    return T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", text))


def drift(docs: DataFrame) -> DataFrame:
    """kind, path, found and expected type (null: not read at all). Scalars are read as text, so any scalar is what is expected.

    The driver sees one merged schema a kind.
    """
    spark, known = docs.sparkSession, T.DataType.fromDDL(ITEM_DDL)
    out = []
    for row in item_schemas(docs).collect():
        for path, found, expected in _fields(_type(row["schema"]), known, ""):
            out.append((row["kind"], path, found.simpleString(), expected.simpleString() if expected is not None else None))
    return spark.createDataFrame(sorted(out), _RESULT)
