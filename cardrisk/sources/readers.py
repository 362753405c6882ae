"""Sources S1-S6: raw JSON Lines, layer tables, catalog views, local rows, id ranges."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import versions
from ..functions.dates import parse_date, parse_timestamp
from ..schemas import CORRUPT_COL, with_corrupt_column


def read_raw_json(spark: SparkSession, path: str | list[str], schema: T.StructType,
                  keep_corrupt: bool = True) -> DataFrame:
    """Scan a directory of JSON Lines with a declared schema.

    No inference job runs over the files.  In PERMISSIVE mode a malformed
    line, or a field of the wrong type, keeps the row: the bad field is NULL
    and the raw line is kept in ``_corrupt_record`` for the quarantine.
    """
    read_schema = with_corrupt_column(schema) if keep_corrupt else schema
    reader = (spark.read.schema(read_schema)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COL))
    return reader.json(path)


def read_raw_json_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S1 as the reference calls it: ``spark.read.json(path)`` with schema
    inference (an extra job over all files; dates stay text, columns come
    back sorted, a bad line adds ``_corrupt_record``).  Follow with
    ``conform`` to get the declared schema."""
    return spark.read.json(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema`` in its column order.

    Missing columns become typed NULLs; text dates and timestamps are parsed
    (X13, invalid -> NULL); other columns are ``try_cast``.  Extra columns
    are dropped, except ``_corrupt_record``.
    """
    present = set(df.columns)
    cols = []
    for field in schema.fields:
        if field.name not in present:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        src, dtype = F.col(field.name), df.schema[field.name].dataType
        if isinstance(field.dataType, T.DateType) and isinstance(dtype, T.StringType):
            cols.append(parse_date(src).alias(field.name))
        elif isinstance(field.dataType, T.TimestampNTZType) and isinstance(dtype, T.StringType):
            cols.append(parse_timestamp(src).alias(field.name))
        elif dtype == field.dataType:
            cols.append(src)
        else:
            cols.append(src.try_cast(field.dataType).alias(field.name))
    if CORRUPT_COL in present and CORRUPT_COL not in schema.fieldNames():
        cols.append(F.col(CORRUPT_COL))
    return df.select(*cols)


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet",
               options: Mapping[str, str] | None = None) -> DataFrame:
    """Read a layer table (latest version: the newest manifest of a changed
    layer, see ``versions``).  ``fmt`` is any Spark source; ``delta`` works when its
    package is on the classpath."""
    if fmt in versions.FORMATS and not options:
        state = versions.manifest(spark, path)
        if state is not None:
            return versions.read(spark, path, fmt, state)
    reader = spark.read.format(fmt)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load(path)


def _place(path: str) -> tuple[str, str]:
    """Store and path of a location; a plain path and its ``file:`` form are equal."""
    parts = urlparse(path)
    return ("" if parts.scheme == "file" else f"{parts.scheme}://{parts.netloc}"
            if parts.scheme else "", parts.path.rstrip("/"))


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                   partition_by: Sequence[str] = (), schema: T.StructType | None = None) -> str:
    """S6 for layer tables: an external catalog table over ``path`` whose
    partitions are tracked in the catalog.

    A path-based read lists every partition directory on each query; a
    catalog table lets a partition filter list only the matching
    directories (``Partition Provider: Catalog``), which is what keeps a
    one-day query cheap on a table with years of daily partitions.  Pass
    the ``schema`` of the DataFrame just written to skip listing the table.

    A table of that name over another location is replaced by one over ``path``
    if it is external (its files stay); a managed table is refused.
    """
    if spark.catalog.tableExists(name):
        described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
                     if r[0] in ("Location", "Type")}
        if _place(described.get("Location", "")) != _place(path):
            if described.get("Type") != "EXTERNAL":
                raise ValueError(f"{name} exists at {described.get('Location')}, not at {path}")
            spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        if schema is None:
            schema = read_layer(spark, path, fmt).schema      # lists the table once
        fields = [f for f in schema.fields if f.name not in partition_by] + \
            [schema[c] for c in partition_by]
        schema = T.StructType(fields)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" \
            if partition_by else ""
        spark.sql(f"CREATE TABLE {name} ({cols}) USING {fmt}{parts} LOCATION '{path}'")
    if partition_by:
        sync_partitions(spark, name)
    else:
        spark.sql(f"REFRESH TABLE {name}")
    return name


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return next((r[1] for r in rows if r[0] == "Location"), "")


def sync_partitions(spark: SparkSession, name: str, partition_col: str | None = None,
                    values: Sequence | None = None) -> None:
    """Make the catalog see partitions written by path: the listed ``values``
    of ``partition_col`` only (a bounded set, e.g. the dates an incremental
    run touched), or every partition when ``values`` is None.

    Partitions of a versioned layer get the location that its manifest names, and
    those that left it leave the catalog.
    """
    path = _location(spark, name)
    state = versions.manifest(spark, path) if path else None
    if state is not None:
        _sync_versions(spark, name, path, state["live"],
                       None if values is None else {f"{partition_col}={v}" for v in values})
    elif values is None:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    elif values:
        specs = " ".join(f"PARTITION (`{partition_col}` = '{v}')" for v in values)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
    spark.sql(f"REFRESH TABLE {name}")


def _sync_versions(spark: SparkSession, name: str, path: str, live: Mapping[str, int],
                   wanted: set[str] | None) -> None:
    def spec(partition: str) -> str:
        pairs = (p.split("=", 1) for p in partition.split("/"))
        return "PARTITION (" + ", ".join(f"`{k}` = '{v}'" for k, v in pairs) + ")"
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    wanted = known | set(live) if wanted is None else wanted
    place = {p: versions.folder_of(path, p, live[p]) for p in sorted(wanted & set(live))}
    for partition in place.keys() & known:
        spark.sql(f"ALTER TABLE {name} {spec(partition)} SET LOCATION '{place[partition]}'")
    new = [f"{spec(p)} LOCATION '{place[p]}'" for p in place if p not in known]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(new)}")
    lost = [spec(p) for p in sorted((wanted & known) - set(live))]
    if lost:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(lost)}")


def latest_partition_value(spark: SparkSession, name: str, partition_col: str):
    """The greatest value of ``partition_col`` among the catalog partitions of
    table ``name`` (metadata only: no data file is opened), or None when the
    table has no tracked partitions (e.g. a temp view)."""
    try:
        columns = spark.catalog.listColumns(name)
    except Exception:  # noqa: BLE001 - unknown name
        return None
    if not any(c.isPartition and c.name == partition_col for c in columns):
        return None     # a view or a table without that partition column
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()   # one row per partition
    prefix = f"{partition_col}="
    values = [part.split("=", 1)[1] for r in rows for part in r[0].split("/")
              if part.startswith(prefix)]
    values = [v for v in values if v != "__HIVE_DEFAULT_PARTITION__"]   # the NULL partition
    return max(values) if values else None


def register_views(spark: SparkSession, views: Mapping[str, DataFrame]) -> None:
    """Expose DataFrames to SQL by catalog name (temp views)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL text against registered views."""
    if views:
        register_views(spark, views)
    return spark.sql(text)


def rows_to_df(spark: SparkSession, rows: Iterable[Mapping | tuple],
               schema: T.StructType) -> DataFrame:
    """A DataFrame from local rows with an explicit schema (test fixtures only;
    without a schema Spark would sort dict keys alphabetically)."""
    return spark.createDataFrame(list(rows), schema=schema)


def id_range(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """``[0, n)`` as column ``id``, generated in parallel on the executors."""
    return spark.range(0, n, 1, partitions)
