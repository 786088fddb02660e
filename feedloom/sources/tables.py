"""Plain tables: schemas, guarded reads, ordered writes, publishing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import fixed
from . import arrays, versions

ENTRY_DDL = (
    "id string, name string, type string, description string, source_url string, stars bigint, category string, "
    "tags array<string>, tech_stack array<string>, "
    "install struct<method:string,config:struct<command:string,args:array<string>,env:map<string,string>,url:string>,"
    "placeholder_hints:map<string,string>,repo:string,files:array<string>,branch:string,path:string,"
    "plugin_name:string,marketplace_repo:string,marketplace_name:string,marketplace_verified:boolean>, "
    "source string, last_synced string, added_at string, pushed_at string, description_zh string, "
    "search_terms array<string>, highlights array<string>, namespace string, source_priority int, "
    "install_count bigint, skills_sh_url string, skills_sh_scraped_at string, mcp_registry_status string, "
    "mcp_registry_published_at string, mcp_remotes array<struct<type:string,url:string>>, version string, "
    "bundle struct<skills_count:bigint,agents_count:bigint,commands_count:bigint,mcp_servers_count:bigint,"
    "hooks_count:bigint,skills_namespaces:array<string>,hook_events:array<string>,mcp_server_names:array<string>,"
    "bundled_skill_ids:array<string>>, manifest_completeness double, marketplace_url string"
)
CACHE_DDL = (
    "cache_key string, entry_id string, content_hash string, rubric_version string, result_json string, "
    "evaluated_at timestamp, expires_at timestamp, model_id string, prompt_tokens bigint, completion_tokens bigint, "
    "cost_usd double, latency_ms bigint"
)
EVAL_RESULT_DDL = (
    "entry_id string, metrics map<string,struct<score:int,evidence:array<string>,missing:array<string>,suggestion:string>>, "
    "enrichment struct<summary:string,summary_zh:string,tags:array<string>,tech_stack:array<string>,search_terms:array<string>,"
    "highlights:array<string>>, installability struct<schema_valid:boolean,state:string,tags:array<string>,reason:string>, "
    "security struct<risk_level:string,verdict:string,red_flags:array<string>,"
    "permissions:struct<files:array<string>,network:array<string>,commands:array<string>>,summary:string,recommendations:array<string>>, "
    "health struct<freshness:double,popularity:double,source_trust:double,install_popularity:double,manifest_completeness:double>, "
    "llm_score double, final_score double, decision string, star_weight double, content_hash string, rubric_version string, "
    "model_id string, evaluated_at timestamp"
)
COMPLETED_DDL = "type string, rubric_version string, entry_id string"
DIFF_DDL = "id string, class string, old string, new string, pct double"
REPO_FILE_DDL = "repo string, ref string, path string, kind string"
QUEUE_DDL = "id string, type string, last_queued_at string"


def entry_schema() -> T.StructType:
    return T.StructType.fromDDL(ENTRY_DDL)


def empty_frame(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system its scheme names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_json_table(
    spark: SparkSession, path: str, schema: str | T.StructType, *, array_file: bool = True, extras: str | None = None, position: str | None = None,
) -> DataFrame:
    """Rows of a JSON file or folder; a missing path or unreadable file gives no rows.

    ``array_file`` reads files that hold one array (or object) each, as feeds are published; a large file is read by many tasks
    (``sources.arrays``). Otherwise every line is an object. ``extras`` names a VARIANT column for the whole object, so that
    keys outside the schema are not lost; ``position`` a column (file, number) with the place of an array's object. A folder
    written with versions is read as of its current one.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    path = current_folder(spark, path)
    if not path_exists(spark, path):
        empty = empty_frame(spark, schema)
        if extras is not None:
            empty = empty.withColumn(extras, F.lit(None).cast("variant"))
        return empty if position is None else empty.withColumn(position, F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("number")))
    if array_file:
        objects = arrays.read_objects(spark, path)
        texts = objects.select(F.col("body").alias("value"), *([F.struct("file", "number").alias(position)] if position else []))
    else:
        texts = spark.read.text(path)
    place = [position] if position and array_file else []
    if extras is not None:
        parsed = F.when(F.try_parse_json("value").isNotNull(), F.from_json("value", "variant"))
        items = texts.select(parsed.alias(extras), *place).filter(F.col(extras).isNotNull())
        return items.select(F.from_json(F.to_json(extras), schema).alias("_r"), extras, *place).select("_r.*", extras, *place)
    if not array_file:
        return split_rejects(texts, "value", schema)[0]
    marked = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    rows = texts.select(F.from_json("value", marked, {"columnNameOfCorruptRecord": "_bad"}).alias("_r"), *place).select("_r.*", *place)
    # an unreadable object is a row of nulls; a row with a bad field keeps the others
    read = F.col("_bad").isNull()
    for f in schema.fields:
        read = read | F.col(f"`{f.name}`").isNotNull()
    return rows.filter(read).drop("_bad")


def current_folder(spark: SparkSession, path: str) -> str:
    """Where the data of ``path`` is: the folder of its current version, or itself where it has none."""
    version = versions.latest(spark, path)[1].get("version")
    return path if version is None else f"{path.rstrip('/')}/{version}"


def _in_version(spark: SparkSession, path: str, version: str | None, write: Callable[[str], None]) -> None:
    """Call ``write`` with the folder to write to. With a version that is a folder of its own below ``path``, which becomes the
    current one when all is written; until then, and if the run dies, readers get the version before."""
    if version is None:
        return write(path)
    if versions.latest(spark, path)[1].get("version") == version:
        return
    write(f"{path.rstrip('/')}/{version}")
    while not versions.commit(spark, path, versions.latest(spark, path)[0] + 1, {"version": version}):
        pass


def split_rejects(df: DataFrame, text: str, schema: str | T.StructType, keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected texts with reason) of a column of JSON texts; a bad one stops nothing."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    marked = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = df.select(*keys, text, F.from_json(text, marked, {"columnNameOfCorruptRecord": "_bad"}).alias("_r"))
    bad = F.col("_r._bad").isNotNull() | F.col("_r").isNull()
    good = parsed.filter(~bad).select(*keys, "_r.*").drop("_bad")
    return good, parsed.filter(bad).select(*keys, text, F.lit("malformed row").alias("reason"))


def read_json_with_rejects(spark: SparkSession, path: str, schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines with reason) of a JSON-lines feed."""
    return split_rejects(spark.read.text(path), "value", schema)


def write_json(df: DataFrame, path: str, order: Sequence[Column | str] = (), version: str | None = None) -> None:
    """Write in row order. The order is a range partitioning, so the files follow it too.

    ``version`` names the run: its files are a version of the table (``current_folder``), so a lost run leaves the old one.
    """
    laid = df.orderBy(*order) if order else df
    _in_version(df.sparkSession, path, version, lambda folder: laid.write.mode("overwrite").json(folder))


def write_json_arrays(df: DataFrame, path: str, order: Sequence[Column | str] = (), version: str | None = None) -> None:
    """As ``write_json``, every file one JSON array."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = "["
        for batch in batches:
            out = []
            for row in batch.column(0).to_pylist():
                out.append(lead + row)
                lead = ","
            yield pa.RecordBatch.from_pydict({"value": out})
        yield pa.RecordBatch.from_pydict({"value": ["]" if lead == "," else "[]"]})

    rows = (df.orderBy(*order) if order else df).select(F.to_json(F.struct(*df.columns)).alias("value"))
    _in_version(df.sparkSession, path, version, lambda folder: rows.mapInArrow(lines, "value string").write.mode("overwrite").text(folder))


def tiered_union(tables: Sequence[tuple[DataFrame, str | Column]], order: str = "_ord") -> DataFrame:
    """Union of tables in the given order, each with its own position column.

    ``order`` becomes (tier, position): the order every later tie-break uses.
    """
    parts = []
    for tier, (df, pos) in enumerate(tables):
        pos = F.col(pos) if isinstance(pos, str) else pos
        parts.append(df.withColumn(order, F.struct(F.lit(tier).alias("tier"), pos.cast("long").alias("pos"))))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def load_threshold(df: DataFrame, measure: str, at_least: int, key: str, order: str) -> DataFrame:
    """Rows from a threshold on, the first of each id, most first."""
    from ..operators.relational import first_per_key

    kept = first_per_key(df.filter(F.coalesce(F.col(measure), F.lit(0)) >= at_least), [key], [F.asc(order)])
    return kept.orderBy(F.desc(measure), key)


def publish_partitions(df: DataFrame, path: str, *, type_: str = "type", order: Sequence[Column], known: Sequence[str] = fixed.TYPES,
                       bundled: str | None = "bundled_in", bundled_type: str = "skill", version: str | None = None) -> None:
    """One folder of JSON per type, best rows first in each file; every known type gets a folder.

    Bundled skills are left out of the skill folder. ``version`` as for ``write_json``.
    """
    rows = publishable(df, type_=type_, bundled=bundled, bundled_type=bundled_type)
    # one range per task, so a task writes one or two files and not one per type
    laid = rows.repartitionByRange(F.col(type_), *order).sortWithinPartitions(F.col(type_), *order)

    def write(to: str) -> None:
        laid.write.mode("overwrite").partitionBy(type_).json(to)
        spark = df.sparkSession
        for t in known:
            folder = f"{to.rstrip('/')}/{type_}={t}"
            if not path_exists(spark, folder):
                spark.createDataFrame([], "value string").coalesce(1).write.mode("overwrite").text(folder)

    _in_version(df.sparkSession, path, version, write)


def publishable(df: DataFrame, *, type_: str = "type", bundled: str | None = "bundled_in", bundled_type: str = "skill") -> DataFrame:
    if bundled is None:
        return df
    return df.filter(~((F.col(type_) == bundled_type) & (F.length(bundled) > 0)) | F.col(bundled).isNull())


def entry_documents(df: DataFrame, *, key: str = "id", type_: str = "type") -> DataFrame:
    """(type, file_id, document): the full JSON of every entry, null fields left out.

    Rows of a table and not one small file each: a file per entry would drown the file system.
    """
    from ..functions.text import file_id

    kind = F.coalesce(F.col(type_), F.lit("unknown")).alias(type_)
    return df.select(kind, file_id(F.coalesce(F.col(key).cast("string"), F.lit("unknown"))).alias("file_id"),
                     F.to_json(F.struct(*df.columns)).alias("document"))


def publish_if_rows(df: DataFrame, write, least: int = 1) -> bool:
    """Call ``write(df)`` only when there are rows; an empty run keeps the old table."""
    enough = df.limit(least).count() >= least
    if enough:
        write(df)
    return enough


def front_matter(fields: Mapping[str, Column]) -> Column:
    """``---`` block with one line per non-null field."""
    lines = [F.when(c.isNotNull(), F.concat(F.lit(f"{k}: "), c.cast("string"))) for k, c in fields.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n"))


def with_front_matter(body: Column, fields: Mapping[str, Column]) -> Column:
    """Put the block on top unless the text has one already."""
    return F.when(F.startswith(F.trim(body), F.lit("---")), body).otherwise(F.concat(front_matter(fields), F.lit("\n"), body))


def export_payload(df: DataFrame, fields: Mapping[str, Column], required: Sequence[Column]) -> DataFrame:
    """``payload`` JSON of the chosen fields (null ones left out), only for rows with all required fields."""
    ok = F.lit(True)
    for r in required:
        ok = ok & (F.length(F.trim(r.cast("string"))) > 0)
    return df.filter(ok).withColumn("payload", F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])))
