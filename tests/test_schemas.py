import dataclasses
import datetime as dt

import pytest
from pyspark.sql import types as T

from fairway.sources.schemas import (
    FORM_INDEX,
    ROUNDS,
    SchemaMismatch,
    check_schema,
    struct_from,
)


def test_struct_from_annotations():
    @dataclasses.dataclass
    class Row:
        a: int
        b: float
        c: str
        d: dt.datetime | None = None
        e: bool | None = None

    schema = struct_from(Row)
    assert [(f.name, f.dataType, f.nullable) for f in schema] == [
        ("a", T.LongType(), True), ("b", T.DoubleType(), True), ("c", T.StringType(), True),
        ("d", T.TimestampNTZType(), True), ("e", T.BooleanType(), True)]


def test_declared_datasets():
    assert ROUNDS.fieldNames()[:6] == ["year", "event_id", "event_name", "dg_id", "player_name",
                                       "round"]
    assert ROUNDS["teetime"].dataType == T.TimestampNTZType()
    assert FORM_INDEX.fieldNames()[-2:] == ["category", "ppi_sg_diff"]


def test_check_schema(spark):
    df = spark.createDataFrame([(1, "x")], "a long, b string")
    expected = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert check_schema(df, expected) is df
    with pytest.raises(SchemaMismatch, match="a: bigint != int"):
        check_schema(df, T.StructType([T.StructField("a", T.IntegerType())]))
    with pytest.raises(SchemaMismatch, match="unexpected column b"):
        check_schema(df, T.StructType([T.StructField("a", T.LongType())]), allow_extra=False)
