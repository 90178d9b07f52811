"""Reports about personal data: per row, per mapping, per dataset, and of the mapping itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType

from maskwright.functions import rows
from maskwright.functions.arrays import bind, evaluated_once
from maskwright.functions.catalogue import MAX_SAMPLES, PREEXISTING_RE, wanted
from maskwright.functions.search import occurring
from maskwright.operators.detect import count_columns, detect
from maskwright.operators.restore import with_vault

MAPPING_KEYS = ["workspace_id", "mapping_id"]


def category_counts(entities: Column) -> Column:
    """Array of (category, count, samples) in order of first appearance in an entity list."""

    def one(category: Column) -> Column:
        return bind(
            F.filter(entities, lambda e: e["category"] == category),
            lambda mine: F.struct(
                category.alias("category"),
                F.size(mine).alias("count"),
                F.transform(
                    F.slice(mine, 1, MAX_SAMPLES), lambda e: e["placeholder"]
                ).alias("samples"),
            ),
        )

    return F.transform(F.array_distinct(F.transform(entities, lambda e: e["category"])), one)


def summarise_entities(
    df: DataFrame,
    entities: str | Column = "entities",
    categories: list[str] | None = None,
    include_samples: bool = True,
    output_field: str = "pii",
) -> DataFrame:
    """Counts per category from an entity list, with placeholders as samples.

    Unlike text detection the category filter is case-sensitive here. The list is summarised
    in its own row, so nothing is shuffled.
    """
    listed = F.coalesce(rows.as_column(entities), F.array())
    if categories:
        listed = F.filter(listed, lambda e: e["category"].isin(*categories))
    out = df.withColumn("__mw_list", listed)
    out = evaluated_once(out, {"__mw_counts": category_counts(F.col("__mw_list"))})
    found = F.col("__mw_counts")
    if not include_samples:
        found = F.transform(
            found, lambda f: f.withField("samples", F.array().cast("array<string>"))
        )
    output = F.struct(
        found.alias("found_pii"),
        F.size("__mw_list").alias("total_count"),
        F.lit(rows.SOURCE).alias("source"),
    )
    return out.withColumn(output_field, output).drop("__mw_list", "__mw_counts")


_NUMBER = "\uE002"


def _printed(value: Column, kind: DataType) -> Column:
    """Doubles as text between marks, whole ones without an exponent, at any depth.

    Keys of maps are quoted in JSON anyway, so doubles there are plain text.
    """
    if isinstance(kind, (DoubleType, FloatType)):
        whole = (F.abs(value) < 1e21) & (value == F.floor(value.cast("decimal(38,6)")))
        text = F.when(whole, value.cast("decimal(22,0)").cast("string")).otherwise(value.cast("string"))
        return F.when(~F.isnan(value), F.concat(F.lit(_NUMBER), text, F.lit(_NUMBER)))
    if isinstance(kind, StructType):
        fields = [_printed(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else value
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _printed(x, kind.elementType))
    if isinstance(kind, MapType):
        shown = F.transform_values(value, lambda _, v: _printed(v, kind.valueType))
        if isinstance(kind.keyType, (DoubleType, FloatType)):
            shown = F.transform_keys(
                shown, lambda k, _: F.translate(_printed(k, kind.keyType), _NUMBER, "")
            )
        return shown
    return value


def row_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The whole row as JSON text, nulls printed, and whole numbers below 1e21 in full."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    shown = [_printed(F.col(f"`{c}`"), kinds[c]).alias(c) for c in columns or df.columns]
    text = F.to_json(F.struct(*shown), {"ignoreNullFields": "false"})
    return F.regexp_replace(text, f'"{_NUMBER}([^"{_NUMBER}]*){_NUMBER}"', "$1")


def row_audit(
    df: DataFrame,
    categories: list[str] | None = None,
    include_samples: bool = False,
    columns: list[str] | None = None,
    output_field: str = "pii",
) -> DataFrame:
    """Detect over the row's JSON, so any field may leak. Hits can span field borders."""
    return detect(df, row_json(df, columns), categories, include_samples, output_field)


def flag_split(df: DataFrame, field: str = "pii") -> tuple[DataFrame, DataFrame]:
    """Rows with findings, and the others.

    Both are filters over the same plan. If both are written, put ``sources.staging.stage``
    before this so that the text is scanned once.
    """
    flagged = F.coalesce(F.col(f"{field}.total_count") > 0, F.lit(False))
    return df.where(flagged), df.where(~flagged)


def audit_log(vault: DataFrame) -> DataFrame:
    """Categories touched per mapping and how often, with no plain values.

    A vault has one row per mapping, so its counts are made in the row. A mapping with one row
    per placeholder is grouped, after a partial count on each side of the shuffle.
    """
    if "entities" not in vault.columns:
        return vault.groupBy(*MAPPING_KEYS, "category").agg(F.count("*").alias("masked"))
    return vault.select(
        *MAPPING_KEYS, F.explode(category_counts(F.col("entities"))).alias("c")
    ).select(
        *MAPPING_KEYS,
        F.col("c.category").alias("category"),
        F.col("c.count").cast("bigint").alias("masked"),
    )


GROUPINGS = ("group", "rollup", "cube")


def dataset_audit(
    df: DataFrame,
    by: list[str],
    text: str | Column = "text",
    categories: list[str] | None = None,
    grouping: str = "group",
    labels: DataFrame | None = None,
    key: list[str] | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Hits and rows with hits per category, rolled up over table columns.

    Null and empty texts end the run, are left out (``skip``), or are counted as scanned (``keep``).

    ``labels`` may bring columns of ``by``, by ``key``. It is joined to the counts of all rows, not to
    their texts, and rows without a label are counted with nulls.

    ``grouping`` is ``group``, ``rollup`` or ``cube``. Rows are counted before anything moves:
    only small partial sums are shuffled, however uneven the groups are, and the per-category
    columns become rows only after that.
    """
    if grouping not in GROUPINGS:
        raise ValueError(f"grouping must be one of {GROUPINGS}, got {grouping!r}")
    cats = wanted(categories)
    names = [c.name.lower() for c in cats]
    counts = [f"n_{n}" for n in names]
    counted = count_columns(df, text, categories, on_error=on_error)
    if labels is not None:
        own = [b for b in by if b not in labels.columns]
        counted = counted.select(*dict.fromkeys([*key, *own]), *counts).join(labels, key, "left")
    counted = counted.select(*by, *counts)
    sums = [F.sum(f"n_{n}").alias(f"h_{n}") for n in names]
    seen = [F.count_if(F.col(f"n_{n}") > 0).alias(f"r_{n}") for n in names]
    out = counted.groupBy(*by).agg(F.count("*").alias("rows_scanned"), *sums, *seen)
    level = []
    if grouping != "group":
        # Grouping sets copy their input once per set, so they get the finest groups, not rows.
        level = [F.grouping_id().alias("level")]
        sets = {"rollup": out.rollup, "cube": out.cube}[grouping](*by)
        totals = ["rows_scanned", *[f"h_{n}" for n in names], *[f"r_{n}" for n in names]]
        out = sets.agg(*level, *[F.sum(t).alias(t) for t in totals])
    per_category = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("category"),
                F.col(f"h_{n}").alias("hits"),
                F.col(f"r_{n}").alias("rows_with_hits"),
            )
            for c, n in zip(cats, names)
        ]
    )
    kept = [*by, *(["level"] if level else []), "rows_scanned"]
    return out.select(*kept, F.inline(per_category)).where("hits > 0")


def leak_check(
    masked: DataFrame,
    vault: DataFrame,
    text: str | Column = "masked_text",
    mapping_id: str | Column = "mapping_id",
    workspace: str | Column | None = None,
) -> DataFrame:
    """Placeholders whose original value still occurs in what is about to leave.

    A report, not a gate: a short value may occur again inside a longer token that no pattern
    matched. The values themselves are not returned. However many values a text has, it is not
    read once for each: see :func:`maskwright.functions.search.occurring`.
    """
    body, given = rows.as_column(text), rows.as_column(mapping_id)
    space = rows.workspace(workspace)
    sent = masked.select(
        body.alias("__mw_body"), given.alias("mapping_id"), space.alias("workspace_id")
    )
    joined = with_vault(
        sent,
        vault,
        F.col("mapping_id"),
        F.col("workspace_id"),
        F.col("__mw_body"),
        ("category", "placeholder", "original"),
    )
    seen = occurring(F.col("__mw_body"), F.col("__mw_entities.original"))
    joined = evaluated_once(joined, {"__mw_seen": seen})
    leaked = F.filter("__mw_entities", lambda e, i: F.get(F.col("__mw_seen"), i))
    return joined.select(*MAPPING_KEYS, F.inline(leaked)).select(
        *MAPPING_KEYS, "category", "placeholder"
    )


def orphan_masked(
    masked: DataFrame,
    vault: DataFrame,
    text: str | Column = "masked_text",
    mapping_id: str | Column = "mapping_id",
    workspace: str | Column | None = None,
) -> DataFrame:
    """Masked rows that hold placeholders but have no mapping."""
    rows_ = masked.where(F.rlike(rows.as_column(text), F.lit(PREEXISTING_RE))).withColumns(
        {"__mw_ws": rows.workspace(workspace), "__mw_id": rows.as_column(mapping_id)}
    )
    known = vault.select(
        F.col("workspace_id").alias("__mw_ws"), F.col("mapping_id").alias("__mw_id")
    )
    return rows_.join(known, ["__mw_ws", "__mw_id"], "left_anti").drop("__mw_ws", "__mw_id")


def unused_mapping(
    masked: DataFrame,
    vault: DataFrame,
    mapping_id: str | Column = "mapping_id",
    workspace: str | Column | None = None,
) -> DataFrame:
    """Mappings that no masked row refers to.

    The ids in use are made distinct first: partial sets are built before the shuffle, so an
    id that very many rows share arrives once per task.
    """
    used = masked.select(
        rows.workspace(workspace).alias("workspace_id"),
        rows.as_column(mapping_id).alias("mapping_id"),
    ).distinct()
    return vault.join(used, MAPPING_KEYS, "left_anti")


def duplicate_mappings(vault: DataFrame) -> DataFrame:
    """Mapping ids that occur more than once; restoring needs this to be empty."""
    return (
        vault.groupBy(*MAPPING_KEYS)
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )
