"""Projections from source fields to typed attributes, sink columns and match keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.functions.normalize import normalizer
from kinweave.schema import Attribute


def mapped_attributes(
    names: Iterable[str], field_types: Mapping[str, Mapping], default_type: str = "TEXT"
) -> list[Attribute]:
    """Attributes for the named fields; a field without an entry is no match key."""
    out = []
    for name in (n.strip() for n in names):
        entry = field_types.get(name)
        if entry is None:
            out.append(Attribute(name, default_type))
        else:
            out.append(Attribute(
                name, entry.get("type", "TEXT"), entry.get("subtype", "NONE"),
                match_key=bool(entry.get("matchKey", entry.get("match_key", False))),
                required=bool(entry.get("required", False)),
                array=bool(entry.get("array", False)), group=entry.get("group"),
            ))
    return out


def map_schema(
    df: DataFrame, attributes: Sequence[Attribute], source_fields: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One typed column per attribute, and the columns `keep`; a value that does not parse becomes NULL.

    `source_fields` maps an attribute to the source column it comes from where the two
    names differ.
    """
    names = source_fields or {}
    return df.select(*[
        F.col(names.get(a.name, a.name)).try_cast(a.data_type).alias(a.name) for a in attributes
    ], *keep)


def normalize(df: DataFrame, attributes: Iterable[Attribute], keep: Iterable[str] = ()) -> DataFrame:
    """Each attribute through its normalizer, `keep` columns as they are."""
    cols = [F.col(k) for k in keep]
    for a in attributes:
        clean = normalizer(a.type, a.subtype)
        if a.array:
            values = F.array_distinct(F.transform(F.col(a.name), clean))
            cols.append(F.filter(values, lambda v: v.isNotNull()).alias(a.name))
        else:
            cols.append(clean(F.col(a.name)).alias(a.name))
    return df.select(*cols)


BASE_COLUMNS = T.StructType([
    T.StructField("ID", T.StringType(), False),
    T.StructField("MATCH_ID", T.StringType()),
    T.StructField("MATCH_SCORE", T.DoubleType()),
    T.StructField("LAST_UPDATED", T.TimestampNTZType()),
])


def sink_struct(attributes: Iterable[Attribute]) -> T.StructType:
    """Target columns: ID, the attributes in upper case, match columns, update time."""
    known = {f.name for f in BASE_COLUMNS}
    own = []
    for a in attributes:
        name = a.name.upper()
        if name not in known:
            known.add(name)
            own.append(T.StructField(name, a.data_type if not a.array else T.StringType()))
    return T.StructType([BASE_COLUMNS["ID"], *own, *BASE_COLUMNS.fields[1:]])


def to_sink(df: DataFrame, attributes: Iterable[Attribute], as_of: datetime | str) -> DataFrame:
    """Cast to the target columns; a column the input lacks is NULL."""
    have = {c.upper(): c for c in df.columns}
    cols = []
    for field in sink_struct(attributes):
        if field.name == "LAST_UPDATED":
            value = F.lit(str(as_of)).cast("timestamp_ntz")
        elif field.name in have:
            value = F.col(have[field.name])
            if isinstance(df.schema[have[field.name]].dataType, T.ArrayType):
                value = F.array_join(value, ",")
            value = value.try_cast(field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        cols.append(value.alias(field.name))
    return df.select(*cols)


# Field names of match records, nested and flat form, and their columns.
RESULT_FIELDS = {
    "id": "ID", "sourceId": "ID", "matchId": "MATCH_ID", "matchScore": "MATCH_SCORE",
    "confidenceScore": "MATCH_SCORE", "matchType": "MATCH_TYPE", "ruleId": "RULE_ID",
}


def rename_results(df: DataFrame) -> DataFrame:
    """Match records with target column names; nested source fields become columns."""
    cols = []
    for name in df.columns:
        if name == "sourceFields":
            inner = df.schema[name].dataType.fieldNames()
            cols += [F.col(f"sourceFields.{f}").alias(f.upper()) for f in inner if f.lower() != "id"]
        else:
            cols.append(F.col(name).alias(RESULT_FIELDS.get(name, name.upper())))
    return df.select(*cols)


def with_source_fields(df: DataFrame, fields: Sequence[str], include: bool = True) -> DataFrame:
    """Pack `fields` into one struct column, or leave them out."""
    rest = [c for c in df.columns if c not in set(fields)]
    packed = [F.struct(*fields).alias("sourceFields")] if include else []
    return df.select(*rest, *packed)


def group_key(*members: Column | str) -> Column:
    """Several attributes as one key, NULL when one of them is NULL."""
    cols = [F.col(m) if isinstance(m, str) else m for m in members]
    whole = cols[0].isNotNull()
    for c in cols[1:]:
        whole = whole & c.isNotNull()
    return F.when(whole, F.concat_ws("\x1f", *cols))


def with_group_keys(df: DataFrame, attributes: Iterable[Attribute]) -> DataFrame:
    """Add one key column per attribute group, named after the group."""
    groups: dict[str, list[str]] = {}
    for a in attributes:
        if a.group:
            groups.setdefault(a.group, []).append(a.name)
    return df.select("*", *[group_key(*members).alias(g) for g, members in groups.items()])


def explode_key(df: DataFrame, id_col: str, key: str) -> DataFrame:
    """One row per record and element of an array key, for any-element equality."""
    return df.select(id_col, F.explode(F.array_distinct(key)).alias(key)).where(F.col(key).isNotNull())
