"""Sources and sinks (S1-S12): JSONL / JSON directories / text lines / CSV / metrics JSON / results.

Schemas are always declared. Malformed lines never abort a job by default: they land
in ``_corrupt_record`` and ``quarantine()`` separates them (``mode='FAILFAST'`` restores
abort-on-error). Writers commit atomically through Spark's output committer.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alignfold.functions.schemas import EVAL_RESULT
from alignfold.functions.text import blank, strip
from alignfold.session import cut_lineage

CORRUPT = "_corrupt_record"
MAX_BROADCAST_SPLITS = 100_000  # some 200 bytes each


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


# ---------- S1 ----------
def parse_lines(lines: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """Typed columns of JSON lines plus ``_corrupt_record``; works on a batch table or a stream.

    Every line that is not blank gives one row. The line goes to ``_corrupt_record`` (and only the
    fields that could be read are set) when it is truncated, followed by other text, not a single
    object, or holds a field of a type that does not fit. The line is read twice: once as the only
    element of an array, which shows whether it is one whole object, and once for its fields.
    """
    full = _with_corrupt(schema)
    kept = lines.filter(~blank(line)).select(F.col(line).alias("_line"))
    row = F.from_json("_line", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    whole = F.from_json(F.concat(F.lit("["), F.col("_line"), F.lit("]")), "array<string>", {"mode": "PERMISSIVE"})
    parsed = kept.select("_line", row.alias("_row"), whole.alias("_whole"))
    sound = ((F.size("_whole") == 1) & F.coalesce(F.col("_whole")[0].startswith("{"), F.lit(False))
             & F.col("_row").isNotNull() & F.col(f"_row.{CORRUPT}").isNull())
    names = [f for f in full.fieldNames() if f != CORRUPT]
    return parsed.select(*[F.col(f"_row.`{n}`").alias(n) for n in names],
                         F.when(~F.coalesce(sound, F.lit(False)), F.col("_line")).alias(CORRUPT))


def read_jsonl(spark: SparkSession, path, schema: T.StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """One JSON object per line; blank lines are skipped; bad lines go to ``_corrupt_record``."""
    if mode == "PERMISSIVE":
        return parse_lines(spark.read.text(path), schema)
    return spark.read.schema(schema).option("mode", mode).json(path)


def quarantine(df: DataFrame) -> tuple:
    """(good rows without the corrupt column, bad rows with only the raw line): split on that column
    alone, so every row is in exactly one of them. Nothing is cached."""
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


# ---------- S2 / S3 ----------
def read_json_dir(spark: SparkSession, train_dir: str, schema: T.StructType, val_dir: str | None = None,
                  mode: str = "PERMISSIVE", layout: str = "auto") -> dict:
    """All ``**/*.json`` and ``**/*.jsonl`` under each directory, one split per directory.

    ``layout`` (for PERMISSIVE): ``lines`` takes every file as JSON lines. ``auto`` takes a ``.json`` file as one
    document when its first line that is not blank starts with ``[`` or is ``{`` alone: an array gives a record for
    each element, an object one record. This costs a pass over the text of the ``.json`` files. A document is
    one row, so at most 2 GB; one that is neither a whole array nor a whole object is taken line by line.
    """
    if layout not in ("auto", "lines"):
        raise ValueError(layout)

    def one(d):
        if not exists(spark, d):
            raise FileNotFoundError(d)
        files = lambda glob: spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        every = "*.{json,jsonl}"
        if mode != "PERMISSIVE":
            return files(every).schema(schema).option("mode", mode).json(d)
        lines, path = files(every).text(d), F.col("_metadata.file_path")
        # as many paths as Spark itself has on the driver to plan the read
        whole = document_files(files("*.json").text(d)) if layout == "auto" else []
        if whole:
            documents = files("*.json").text(d, wholetext=True).filter(path.isin(whole))
            lines = lines.filter(~path.isin(whole)).unionByName(document_records(documents))
        return parse_lines(lines, schema)
    out = {"train": one(train_dir)}
    if val_dir:
        out["validation"] = one(val_dir)
    return out


def document_files(lines: DataFrame) -> list[str]:
    """Paths of the files whose first line that is not blank opens an array, or an object and nothing else."""
    text = F.trim(F.regexp_replace("value", r"^\uFEFF|[\t\r\n]", ""))
    first = lines.filter((F.col("_metadata.file_block_start") == 0) & ~blank("value")).select(
        F.col("_metadata.file_path").alias("path"), F.substring(text, 1, 2).alias("opens"),
        F.monotonically_increasing_id().alias("at"))
    opens = first.groupBy("path").agg(F.min_by("opens", "at").alias("opens"))
    return [r["path"] for r in opens.filter(F.col("opens").startswith("[") | (F.col("opens") == "{")).collect()]


def document_records(documents: DataFrame, text: str = "value") -> DataFrame:
    """``value``: the elements of each array, each whole object, and the lines of what is neither."""
    elements = lambda c: F.from_json(c, "array<string>", {"mode": "PERMISSIVE"})
    whole = F.regexp_replace(text, r"^\uFEFF", "")
    array = F.ltrim(F.regexp_replace(whole, r"^\s+", "")).startswith("[")
    got = documents.select(whole.alias(text)).withColumn("_got", F.when(array, elements(F.col(text))).otherwise(
        elements(F.concat(F.lit("["), F.col(text), F.lit("]")))))
    # objects side by side would make one array: several elements of what is no array are lines
    sound = F.col("_got").isNotNull() & (array | (F.size("_got") == 1))
    records = F.when(sound, F.transform("_got", lambda e: F.coalesce(e, F.lit("null")))).otherwise(F.split(text, r"\r\n|\r|\n"))
    return got.select(F.explode(records).alias(text))


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of this library's own, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# ---------- S4 ----------
def read_lines(spark: SparkSession, path) -> DataFrame:
    """Text lines, each stripped; blank lines are kept. ``file`` and ``line_key`` (0, 1, ... in the
    file) name a line and do not depend on how Spark cuts the files. Lines end with LF, CR LF or CR; an
    empty file has none.

    A file is read in as many splits as it has. Rows of a split come in order, so a line's key is its
    place in the split after the lines of the splits before it. These are counted in a pass of their
    own; the counts, one row a split, are broadcast up to MAX_BROADCAST_SPLITS of them. The two passes
    see the same splits, as long as the files and the session's file settings stay.
    """
    meta = F.col("_metadata")
    rows = spark.read.text(path).select(
        "value", F.input_file_name().alias("file"), meta["file_path"].alias("_path"), meta["file_block_start"].alias("_block"),
        F.monotonically_increasing_id().alias("_at"))
    counts = cut_lineage(rows.groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")))
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = counts.select("_path", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    if counts.count() <= MAX_BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    placed = rows.join(splits, ["_path", "_block"])
    return placed.select(strip("value").alias("line"), "file", (F.col("_before") + F.col("_at") - F.col("_first")).alias("line_key"))


# ---------- S5 ----------
def read_table(spark: SparkSession, name: str, split: str | None = None, base_dir: str | None = None) -> DataFrame:
    """A named dataset: a catalog table, or ``{base_dir}/{name}[/{split}]`` as Parquet."""
    if base_dir is None:
        return spark.table(name if split is None else f"{name}_{split}")
    return spark.read.parquet(f"{base_dir}/{name}" + (f"/{split}" if split else ""))


# ---------- S6 / S7 ----------
def write_jsonl(df: DataFrame, path: str, order_by=None, single_file: bool = False, mode: str = "overwrite") -> None:
    """UTF-8 JSON lines (non-ASCII kept as is); optional global order; optional single file
    (only for small outputs: it funnels the data through one task)."""
    out = df.orderBy(*order_by) if order_by else df
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_results(df: DataFrame, path: str) -> None:
    """Inference results {Input, Output}: replaced atomically as one commit (instead of delete + append)."""
    df.select("Input", "Output").write.mode("overwrite").json(path)


# ---------- S8 / S12 ----------
def read_metrics(spark: SparkSession, path) -> DataFrame:
    """Flat metric JSON files (one object per file, pretty-printed or not) -> long (run, metric, value).

    run = the ``run=`` folder of the path when present (as ``write_metrics`` lays it out),
    else the file's parent directory name (one results file per run directory). A value that is no
    number has a null ``value`` and its text in ``raw``; a file that is no object gives one row with
    a null metric and the file's text in ``raw``.
    """
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    run = F.coalesce(F.nullif(F.regexp_extract("file", r"/run=([^/]+)/", 1), F.lit("")),
                     F.regexp_extract("file", r"([^/]+)/[^/]+$", 1))
    texts = F.from_json("value", "map<string,string>")
    long = raw.select(run.alias("run"), F.col("value").alias("whole"), F.explode_outer(texts).alias("metric", "text"))
    number = F.expr("try_cast(text AS double)")
    bad = F.when(F.col("metric").isNull(), F.col("whole")).when(number.isNull(), F.col("text"))
    return long.select("run", "metric", number.alias("value"), bad.alias("raw"))


def write_metrics(df: DataFrame, path: str, run_col: str = "run", phase_col: str = "phase") -> None:
    """One flat JSON object {name: value, ...} per run and phase, under ``run=<run>/phase=<phase>/``.

    A metric named twice in one phase keeps its greatest value (there can be only one per name)."""
    one = df.groupBy(run_col, phase_col, "metric").agg(F.max("value").alias("value"))
    out = one.groupBy(run_col, phase_col).agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value"))))).alias("value"))
    out.write.mode("overwrite").partitionBy(run_col, phase_col).text(path)


# ---------- S9 ----------
def read_csv_bom(spark: SparkSession, path, schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """CSV with an optional UTF-8 byte-order mark (Spark's reader drops it itself)."""
    r = spark.read.option("header", str(header).lower()).option("encoding", "UTF-8")
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


# ---------- S10 ----------
def read_results(spark: SparkSession, path) -> DataFrame:
    """Inference results; ``Input`` parsed as the question record when it is JSON, else kept as text.
    Lines that are no record keep their text in ``_corrupt_record`` (see ``quarantine``)."""
    from alignfold.operators.metrics import parse_results

    return parse_results(read_jsonl(spark, path, EVAL_RESULT))


# ---------- S11 ----------
def ensure_stage(spark: SparkSession, path: str, build: Callable[[], DataFrame], fmt: str = "parquet") -> DataFrame:
    """Run ``build`` and write its result only when ``path`` has no committed output (``_SUCCESS``)."""
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)
