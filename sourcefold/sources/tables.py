"""Tables in files: CSV with headers, JSON documents, snapshots with manifests, pinned corpora."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share, spark.checkpoint.dir; only a local session, as in tests, may leave that unset."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        top = tempfile.mkdtemp(prefix="sourcefold-")
    path = f"{top.rstrip('/')}/files-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)  # results are lazy, so no sooner
    return path


def kept(rows: DataFrame) -> DataFrame:
    """The same rows read from a table in the shared folder: what several steps use is worked out once, and lost executors cost no more."""
    path = scratch(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def read_csv(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """All columns as text; quoted line breaks and a byte order mark are fine; empty fields are empty texts."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8", enforceSchema=True).fillna("")


def write_fixed(rows: DataFrame, path: str, header: list[str]) -> None:
    """The columns of the header, in order, replaced as a whole; columns that a row set lacks are null, others are dropped."""
    rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in header]).write.mode("overwrite").parquet(path)


def write_csv(rows: DataFrame, path: str, header: list[str]) -> None:
    """The columns of the header, in order, as CSV files with it; columns that a row set lacks are empty, others are dropped.

    The files are written whole beside the path, which is then renamed to them: a job that fails leaves the old ones. No
    reader finds half a table; between the two renamings it may find none.
    """
    written, before = f"{path}.{uuid.uuid4().hex}", f"{path}.{uuid.uuid4().hex}"
    rows.select(*[F.col(c) if c in rows.columns else F.lit("").alias(c) for c in header]).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(written)
    spark = rows.sparkSession
    place = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    store = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(place(path)):
        store.rename(place(path), place(before))
    if not store.rename(place(written), place(path)):
        raise OSError(f"{written} could not be renamed to {path}")
    store.delete(place(before), True)


def first_present(*names: str) -> Column:
    """The first of several columns that isn't blank; 0 is a value."""
    return F.coalesce(*[F.nullif(F.trim(F.col(n).cast("string")), F.lit("")) for n in names])


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document per file: (name, document, broken). An unreadable document is a row that says so."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value")
    return text.select("name", F.from_json("value", schema).alias("document"), F.expr("try_parse_json(value) IS NULL").alias("broken"))


def tolerant_json(text: Column, schema: str) -> Column:
    """A JSON object out of a reply: as it is, within code fences, or from the first brace to the last."""
    bare = F.regexp_replace(F.trim(text), r"(?s)^```[a-z]*\s*|\s*```$", "")
    inner = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.coalesce(F.when(bare.startswith("{") & bare.endswith("}"), F.from_json(bare, schema)), F.when(inner != "", F.from_json(inner, schema)))


def choose_run(runs: DataFrame, *, pinned: str | None = None) -> DataFrame:
    """One row (run, newest, rows): the pinned run, else the newest by date, nulls last, then the greater id."""
    every = runs.groupBy("run").agg(F.max("date").alias("newest"), F.count("*").alias("rows"), F.count_distinct("linkage").alias("linkages"))
    if pinned is not None:
        every = every.where(F.col("run") == pinned)
    return every.orderBy(F.desc_nulls_last("newest"), F.desc("run")).limit(1)


def snapshot(rows: DataFrame, path: str) -> DataFrame:
    """Writes rows and a manifest (rows, checksum over all columns, whatever their order) beside them; returns the manifest."""
    rows.write.mode("errorifexists").parquet(f"{path}/rows")
    kept = rows.sparkSession.read.parquet(f"{path}/rows")
    manifest = kept.agg(F.count("*").alias("rows"), F.bit_xor(F.xxhash64(*kept.columns)).alias("checksum"))
    manifest.write.mode("errorifexists").json(f"{path}/manifest")
    return rows.sparkSession.read.schema(manifest.schema).json(f"{path}/manifest")


def pinned(rows: DataFrame, path: str) -> DataFrame:
    """Rows as they were first written to path; a different supply later is an error."""
    spark = rows.sparkSession
    try:
        held = spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows.write.mode("errorifexists").parquet(path)
        return spark.read.parquet(path)
    if not held.exceptAll(rows).isEmpty() or not rows.exceptAll(held).isEmpty():
        raise ValueError(f"the rows supplied differ from those pinned at {path}")
    return held


def one_run(rows: DataFrame, column: str) -> DataFrame:
    """(runs, run): how many runs a table names, and the run if it is one."""
    return rows.agg(F.count_distinct(column).alias("runs"), F.when(F.count_distinct(column) == 1, F.min(column)).alias("run"))


def union_of_runs(tables: dict[str, DataFrame], required: list[str]) -> DataFrame:
    """The tables of several runs as one, tagged with `run`; columns that a layout lacks are null. A missing required column is an error."""
    out = None
    for run, rows in tables.items():
        if missing := [c for c in required if c not in rows.columns]:
            raise ValueError(f"run {run} lacks {', '.join(missing)}")
        rows = rows.withColumn("run", F.lit(run))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
