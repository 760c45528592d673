"""Declared schemas of every dataset the engine reads or writes."""

from __future__ import annotations

import dataclasses
import datetime as _dt
import types
import typing

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_PY_TO_SPARK = {
    int: T.LongType(),
    float: T.DoubleType(),
    str: T.StringType(),
    bool: T.BooleanType(),
    # wall-clock times without a zone
    _dt.datetime: T.TimestampNTZType(),
    _dt.date: T.DateType(),
}


def struct_from(cls) -> T.StructType:
    """Schema from the annotated fields of a dataclass (or any annotated
    class). For ``X | None`` the first member decides the type; every column
    is nullable."""
    hints = typing.get_type_hints(cls)
    names = ([f.name for f in dataclasses.fields(cls)] if dataclasses.is_dataclass(cls)
             else list(hints))
    fields = []
    for name in names:
        hint = hints[name]
        if isinstance(hint, types.UnionType) or typing.get_origin(hint) is typing.Union:
            hint = typing.get_args(hint)[0]
        fields.append(T.StructField(name, _PY_TO_SPARK[hint], True))
    return T.StructType(fields)


# The column names of the datasets and feeds below.


@dataclasses.dataclass
class Round:
    """One player's round at one event (logical key: year, event_id, dg_id, round)."""

    year: int
    event_id: int
    event_name: str
    dg_id: int
    player_name: str
    round: int
    course_name: str
    course_num: int
    course_par: int
    score: int
    sg_app: float
    sg_arg: float
    sg_ott: float
    sg_putt: float
    sg_t2g: float
    sg_total: float
    teetime: _dt.datetime | None = None


@dataclasses.dataclass
class VenueRow:
    course_name: str
    course_num: int
    latitude: float
    longitude: float
    location: str


@dataclasses.dataclass
class FormIndexRow:
    """One row of the rolling form-index dataset."""

    dg_id: int
    player_name: str
    ppi: float
    teetime: _dt.datetime
    first_tee_time_in_group: _dt.datetime
    sg_total: float
    score: int
    event_name: str
    wave_average: float
    course_factor_star: float
    category: str
    ppi_sg_diff: float


ROUNDS = struct_from(Round)
# What a stored round landed from (absent in datasets written without it): the
# file's time and name, and its place in the document. Orders landings of a round.
LANDED = T.StructField("landed", T.StructType([
    T.StructField("at", T.TimestampType()), T.StructField("file", T.StringType()), T.StructField("listed", T.LongType())]))
COURSE_INFO = struct_from(VenueRow)
FORM_INDEX = struct_from(FormIndexRow)

EVENT_DIFFICULTY = T.StructType([
    T.StructField("year", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("course_name", T.StringType()),
    T.StructField("course_num", T.LongType()),
    T.StructField("over_80", T.LongType()),
    T.StructField("sub_70", T.LongType()),
    T.StructField("total_rounds", T.LongType()),
    T.StructField("scoring_average", T.DoubleType()),
    T.StructField("pti", T.DoubleType()),
    T.StructField("major_championship", T.BooleanType()),
])

COURSE_FACTOR = T.StructType([
    T.StructField("course_num", T.LongType()),
    T.StructField("course_name", T.StringType()),
    T.StructField("total_over_80", T.LongType()),
    T.StructField("total_sub_70", T.LongType()),
    T.StructField("total_rounds", T.LongType()),
    T.StructField("scoring_average", T.DoubleType()),
    T.StructField("other_over_80", T.LongType()),
    T.StructField("other_sub_70", T.LongType()),
    T.StructField("course_factor", T.DoubleType()),
    T.StructField("course_factor_star", T.DoubleType()),
])

# Landed feed documents. Only the fields the engine uses are declared, so the
# JSON reader prunes everything else (birdies, gir, ...).
EVENT_LIST = T.StructType([
    T.StructField("calendar_year", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("sg_categories", T.StringType()),
    T.StructField("traditional_stats", T.StringType()),
    T.StructField("tour", T.StringType()),
])

ROUND_DETAIL = T.StructType([
    T.StructField("course_name", T.StringType()),
    T.StructField("course_num", T.LongType()),
    T.StructField("course_par", T.LongType()),
    T.StructField("score", T.LongType()),
    T.StructField("sg_app", T.DoubleType()),
    T.StructField("sg_arg", T.DoubleType()),
    T.StructField("sg_ott", T.DoubleType()),
    T.StructField("sg_putt", T.DoubleType()),
    T.StructField("sg_t2g", T.DoubleType()),
    T.StructField("sg_total", T.DoubleType()),
    T.StructField("teetime", T.StringType()),
])

PLAYER_SCORES = T.StructType(
    [T.StructField("dg_id", T.LongType()), T.StructField("player_name", T.StringType())]
    + [T.StructField(f"round_{i}", ROUND_DETAIL) for i in range(1, 5)]
)

EVENT_PAYLOAD = T.StructType([
    T.StructField("event_name", T.StringType()),
    # the feed sends the id as text here and as a number in the event list
    T.StructField("event_id", T.StringType()),
    T.StructField("event_completed", T.StringType()),
    T.StructField("year", T.LongType()),
    T.StructField("season", T.LongType()),
    T.StructField("tour", T.StringType()),
    T.StructField("scores", T.ArrayType(PLAYER_SCORES)),
])

# What a reader could not parse as declared lands here, whole.
CORRUPT = "_corrupt_record"
LANDED_PAYLOAD = T.StructType([*EVENT_PAYLOAD.fields, T.StructField(CORRUPT, T.StringType())])
LANDED_EVENT_LIST = T.StructType([*EVENT_LIST.fields, T.StructField(CORRUPT, T.StringType())])


class SchemaMismatch(ValueError):
    """Raised when stored data does not carry a declared column/type."""


def check_schema(df: DataFrame, expected: T.StructType, *, allow_extra: bool = True) -> DataFrame:
    """Fail fast when ``df`` lacks a declared column or types differ.

    Spark null-fills a declared column that is missing from Parquet files, so
    readers compare the files' own schema with the declaration first.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in expected.fields:
        if field.name not in actual:
            problems.append(f"missing column {field.name}")
        elif actual[field.name] != field.dataType:
            problems.append(f"{field.name}: {actual[field.name].simpleString()} != "
                            f"{field.dataType.simpleString()}")
    if not allow_extra:
        extra = set(actual) - {f.name for f in expected.fields}
        problems.extend(f"unexpected column {name}" for name in sorted(extra))
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df
