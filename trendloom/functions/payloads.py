"""Column expressions over the JSON widget payloads of an explore answer.

Each function maps one payload column to an array of typed structs in the same
row.  The long tables are a plain ``inline`` of these arrays and the nested
answers use them as they are, so neither form needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .times import epoch_timestamp

# Fixed value: origin that relative links are resolved against.
LINK_ORIGIN = "https://trends.google.com"

# Values are read as text and cast afterwards: one odd cell must not null a row.
_TIMELINE = (
    "default STRUCT<timelineData: ARRAY<STRUCT<time: STRING, value: ARRAY<STRING>,"
    " isPartial: BOOLEAN>>, averages: ARRAY<STRING>>"
)
_REGIONS = (
    "default STRUCT<geoMapData: ARRAY<STRUCT<geoCode: STRING, geoName: STRING,"
    " value: ARRAY<STRING>, maxValueIndex: STRING, hasData: ARRAY<BOOLEAN>>>>"
)
_RELATED = (
    "default STRUCT<rankedList: ARRAY<STRUCT<rankedKeyword: ARRAY<STRUCT<query: STRING,"
    " value: STRING, formattedValue: STRING, link: STRING>>>>>"
)


def strip_prefix(payload: Column) -> Column:
    """Drop the anti-hijack prefix in front of the first brace, if any."""
    return F.when(F.contains(payload, F.lit("{")), F.substr(payload, F.instr(payload, "{"))).otherwise(payload)


def is_bad_payload(payload: Column) -> Column:
    """True when a delivered payload is not a JSON object."""
    parsed = F.try_parse_json(strip_prefix(payload))
    return payload.isNotNull() & (parsed.isNull() | ~F.schema_of_variant(parsed).startswith("OBJECT"))


def _whole(text: Column) -> Column:
    """Whole number in a text cell, 0 when there is none."""
    return F.coalesce(text.try_cast("double").try_cast("int"), F.lit(0))


def _value_at(values: Column, position) -> Column:
    return _whole(F.get(values, position))


def _or_empty(array: Column, ddl: str) -> Column:
    return F.coalesce(array, F.array().cast(ddl))


def series_points(payload: Column) -> Column:
    """Interest series of one keyword: ``ARRAY<STRUCT<ts, value, is_partial>>``."""
    data = F.from_json(strip_prefix(payload), _TIMELINE)
    points = F.transform(
        data["default"]["timelineData"],
        lambda e: F.struct(
            epoch_timestamp(e["time"]).alias("ts"),
            _value_at(e["value"], F.lit(0)).alias("value"),
            F.coalesce(e["isPartial"], F.lit(False)).alias("is_partial"),
        ),
    )
    return _or_empty(points, "array<struct<ts:timestamp,value:int,is_partial:boolean>>")


def comparison_points(payload: Column, keywords: Column) -> Column:
    """Shared-scale series: one struct per (time, keyword), missing cells are 0."""
    data = F.from_json(strip_prefix(payload), _TIMELINE)
    per_time = F.transform(
        data["default"]["timelineData"],
        lambda e: F.transform(
            keywords,
            lambda k, i: F.struct(
                epoch_timestamp(e["time"]).alias("ts"),
                i.cast("int").alias("kw_pos"),
                k.alias("keyword"),
                _value_at(e["value"], i).alias("value"),
                F.coalesce(e["isPartial"], F.lit(False)).alias("is_partial"),
            ),
        ),
    )
    ddl = "array<struct<ts:timestamp,kw_pos:int,keyword:string,value:int,is_partial:boolean>>"
    return _or_empty(F.flatten(per_time), ddl)


def comparison_averages(payload: Column, keywords: Column) -> Column:
    """Delivered average per keyword, 0 when the list is short or missing."""
    data = F.from_json(strip_prefix(payload), _TIMELINE)
    return F.transform(
        keywords,
        lambda k, i: F.struct(
            i.cast("int").alias("kw_pos"),
            k.alias("keyword"),
            _value_at(data["default"]["averages"], i).alias("average"),
        ),
    )


def region_rows(payload: Column) -> Column:
    """Regions of one keyword; a region counts only when its first flag is set."""
    data = F.from_json(strip_prefix(payload), _REGIONS)
    kept = F.filter(
        data["default"]["geoMapData"], lambda e: F.coalesce(F.get(e["hasData"], F.lit(0)), F.lit(False))
    )
    rows = F.transform(
        kept,
        lambda e, i: F.struct(
            (i + 1).cast("int").alias("pos"),
            F.coalesce(e["geoCode"], F.lit("")).alias("geo_code"),
            F.coalesce(e["geoName"], F.lit("")).alias("geo_name"),
            _value_at(e["value"], F.lit(0)).alias("value"),
        ),
    )
    return _or_empty(rows, "array<struct<pos:int,geo_code:string,geo_name:string,value:int>>")


def comparison_regions(payload: Column, keywords: Column) -> Column:
    """Regions of a comparison with the value per keyword and the winner.

    The winner is the delivered index when it points at a keyword, otherwise
    the first keyword that reaches the largest value.
    """
    data = F.from_json(strip_prefix(payload), _REGIONS)
    kept = F.filter(
        data["default"]["geoMapData"],
        lambda e: F.exists(e["hasData"], lambda flag: F.coalesce(flag, F.lit(False))),
    )

    def row(entry: Column) -> Column:
        values = F.transform(keywords, lambda _, i: _value_at(entry["value"], i))
        index = entry["maxValueIndex"].try_cast("int")
        first_largest = (F.array_position(values, F.array_max(values)) - 1).cast("int")
        winner = F.when((index >= 0) & (index < F.size(keywords)), index).otherwise(first_largest)
        return F.struct(
            F.coalesce(entry["geoCode"], F.lit("")).alias("geo_code"),
            F.coalesce(entry["geoName"], F.lit("")).alias("geo_name"),
            values.alias("keyword_values"),
            F.get(keywords, winner).alias("top_keyword"),
        )

    ddl = "array<struct<geo_code:string,geo_name:string,keyword_values:array<int>,top_keyword:string>>"
    return _or_empty(F.transform(kept, row), ddl)


def related_rows(payload: Column) -> Column:
    """Related queries: the first ranked list is *top*, the second *rising*."""
    data = F.from_json(strip_prefix(payload), _RELATED)

    def one(bucket: str, index: int) -> Column:
        ranked = F.get(data["default"]["rankedList"], F.lit(index))["rankedKeyword"]
        rows = F.transform(
            ranked,
            lambda e, i: F.struct(
                F.lit(bucket).alias("bucket"),
                (i + 1).cast("int").alias("pos"),
                F.coalesce(e["query"], F.lit("")).alias("query"),
                _whole(e["value"]).alias("value"),
                F.coalesce(e["formattedValue"], F.lit("")).alias("formatted_value"),
                F.when(e["link"].startswith("/"), F.concat(F.lit(LINK_ORIGIN), e["link"]))
                .otherwise(F.coalesce(e["link"], F.lit("")))
                .alias("link"),
            ),
        )
        return _or_empty(
            rows,
            "array<struct<bucket:string,pos:int,query:string,value:int,formatted_value:string,link:string>>",
        )

    return F.concat(one("top", 0), one("rising", 1))
