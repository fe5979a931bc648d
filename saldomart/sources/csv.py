"""CSV in and out. Schemas are explicit and every file's header is checked."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldomart.functions.dates import DATE_FORMATS, date_from_text, dates_by_file
from saldomart.functions.sizes import observed, rows_digest
from saldomart.session import hadoop_path, move_folder, new_folder, read_text, remove_folder, write_text

NULL_TEXT = r"\N"
_RAW = "_raw_row"
FILE = "_file"
_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _options(sep: str, encoding: str) -> dict[str, str]:
    return {
        "header": "true",
        "sep": sep,
        "encoding": encoding,
        "quote": '"',
        "escape": '"',
        "nullValue": NULL_TEXT,
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "timestampFormat": _MICROS,
        "timestampNTZFormat": _MICROS,
    }


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    encoding: str = "UTF-8",
    multi_line: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """CSV files with a header that must equal ``schema``.

    ``multi_line`` allows line breaks inside values. A file is then one task, which is
    why ``export_csv`` can bound the rows per file.
    """
    return (
        spark.read.schema(schema)
        .options(**_options(sep, encoding))
        .option("enforceSchema", "false")
        .option("multiLine", str(multi_line).lower())
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", _RAW)
        .csv(path)
    )


def read_csv_landing(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    encoding: str = "UTF-8",
    stage_dir: str | None = None,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the rows that do not fit the schema as text with a reason.

    The parsed rows are written once and split afterwards: which rows Spark calls
    corrupt depends on the columns a query uses, and the files are parsed only once.
    """
    wide = T.StructType([*schema.fields, T.StructField(_RAW, T.StringType())])
    stage = stage_dir or new_folder(spark, "landing")
    raw = read_csv(spark, path, wide, sep, encoding, multi_line, mode="PERMISSIVE")
    raw.write.mode("errorifexists").parquet(stage)
    staged = spark.read.schema(wide).parquet(stage)
    good = staged.filter(F.col(_RAW).isNull()).drop(_RAW)
    rejects = staged.filter(F.col(_RAW).isNotNull()).select(
        F.col(_RAW).alias("raw_row"), F.lit("does not fit the schema").alias("reason")
    )
    return good, rejects


def read_csv_text(
    spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """CSV rows as text, the file each came from (``_file``), and the raw line of rows with another number of fields."""
    text = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    wide = T.StructType([*text, T.StructField(_RAW, T.StringType())])
    raw = read_csv(spark, path, wide, sep, encoding, mode="PERMISSIVE")
    return raw.select("*", F.col("_metadata.file_path").alias(FILE))


def read_csv_typed(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    formats: Sequence[str] = DATE_FORMATS,
    required: Sequence[str] = (),
    sep: str = ",",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Rows of ``schema`` with ``reason`` and ``raw_row``, both NULL on good rows.

    The files are read as text and converted in the same pass, see ``typed_rows``.
    """
    return typed_rows(read_csv_text(spark, path, schema, sep, encoding), schema, formats, required, sep)


def typed_rows(
    raw: DataFrame,
    schema: T.StructType,
    formats: Sequence[str] = DATE_FORMATS,
    required: Sequence[str] = (),
    sep: str = ",",
    by_file: bool = False,
) -> DataFrame:
    """Text rows converted to ``schema``, with ``reason`` and ``raw_row``, both NULL on good rows.

    Dates are read by the first of ``formats`` that fits, or ``by_file`` in the format of
    their file and column. A row is bad if it has another number of fields, a value of
    another type, a date of no format or of several, or nothing in a ``required`` column.
    """
    days = [f.name for f in schema.fields if isinstance(f.dataType, T.DateType)]
    if by_file and days:
        raw, dates, ambiguous = dates_by_file(raw, days, formats, FILE)
    else:
        dates, ambiguous = {c: date_from_text(F.col(c), formats) for c in days}, {}
    typed, unfit, undated, unclear, missing = {}, [], [], [], []
    for f in schema.fields:
        column = F.col(f.name)
        given = column.isNotNull() & (F.trim(column) != "")
        if isinstance(f.dataType, T.StringType):
            typed[f.name] = column
        elif f.name in dates:
            typed[f.name], two = dates[f.name], ambiguous.get(f.name, F.lit(False))
            undated.append(F.when(given & typed[f.name].isNull() & ~two, F.lit(f.name)))
            unclear.append(F.when(given & two, F.lit(f.name)))
        else:
            typed[f.name] = F.trim(column).try_cast(f.dataType)
            unfit.append(F.when(given & typed[f.name].isNull(), F.lit(f.name)))
        if f.name in required:
            missing.append(F.when(~F.coalesce(given, F.lit(False)), F.lit(f.name)))

    def named(found: list[Column]) -> Column:
        return F.concat_ws(", ", *found) if found else F.lit("")

    reason = (
        F.when(F.col(_RAW).isNotNull() | (named(unfit) != ""), F.lit("does not fit the schema"))
        .when(named(undated) != "", F.concat(F.lit("bad date: "), named(undated)))
        .when(named(unclear) != "", F.concat(F.lit("ambiguous date: "), named(unclear)))
        .when(named(missing) != "", F.concat(F.lit("no "), named(missing)))
    )
    line = F.coalesce(F.col(_RAW), F.to_csv(F.struct(*schema.fieldNames()), {"sep": sep, "escape": '"'}))
    return raw.select(
        *[typed[f.name].alias(f.name) for f in schema.fields],
        reason.alias("reason"),
        F.when(reason.isNotNull(), line).alias("raw_row"),
    )


# Exports and their manifest

_MANIFEST = "_manifest.json"  # readers of the folder pass over it


class IncompleteExport(ValueError):
    """A folder does not hold what its manifest says."""


def _files(spark: SparkSession, path: str) -> dict[str, int]:
    """Name and size of the data files of a folder."""
    fs, folder = hadoop_path(spark, path)
    found = {s.getPath().getName(): s.getLen() for s in fs.listStatus(folder) if s.isFile()}
    return {name: size for name, size in sorted(found.items()) if not name.startswith(("_", "."))}


def read_manifest(spark: SparkSession, path: str | list[str]) -> dict | None:
    """What an export noted: files with their sizes, number of rows, digest of the rows; None without a manifest."""
    if not isinstance(path, str):
        return None
    text = read_text(spark, f"{path.rstrip('/')}/{_MANIFEST}")
    return None if text is None else json.loads(text)


def check_files(spark: SparkSession, path: str | list[str], edited: bool = False) -> dict | None:
    """The manifest of a folder, after its files were compared with it.

    A file that is absent, or has another size, is refused; where the files may be
    ``edited``, only an absent one is.
    """
    manifest = read_manifest(spark, path)
    if manifest is None:
        return None
    found = _files(spark, path)
    absent = sorted(manifest["files"].keys() - found.keys())
    if absent:
        raise IncompleteExport(f"{path} lacks {', '.join(absent)}")
    changed = sorted(name for name, size in manifest["files"].items() if found[name] != size)
    changed += sorted(found.keys() - manifest["files"].keys())
    if changed and not edited:
        raise IncompleteExport(f"{path} is not as it was exported: {', '.join(changed)}")
    return manifest


def export_csv(
    df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8", max_rows_per_file: int = 1_000_000
) -> int:
    """Write ``df`` as a folder of CSV files with column headings. Returns the number of rows.

    The files are written beside ``path`` and take its place when they are complete, so a
    failed export leaves an earlier one as it was. A manifest beside them names the files,
    their sizes, the number of rows and a digest that does not depend on their order, both
    taken while writing.
    """
    spark = df.sparkSession
    seen = Observation()
    new = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    try:
        (
            df.select([_guarded(f) for f in df.schema.fields])
            .observe(seen, F.count(F.lit(1)).alias("rows"), rows_digest(df).alias("digest"))
            .write.options(**_options(sep, encoding))
            .option("maxRecordsPerFile", max_rows_per_file)
            .csv(new)
        )
        found = observed(seen, ["rows", "digest"])
        manifest = {"files": _files(spark, new), "rows": found["rows"], "digest": str(found["digest"])}
        write_text(spark, f"{new}/{_MANIFEST}", json.dumps(manifest))
    except Exception:
        remove_folder(spark, new)
        raise
    remove_folder(spark, path)
    move_folder(spark, new, path)
    return found["rows"]


def _guarded(field: T.StructField):
    """The column; text that would be read back as NULL stops the export."""
    column = F.col(field.name)
    if not isinstance(field.dataType, T.StringType):
        return column
    message = F.lit(f"column {field.name} holds the text that stands for NULL")
    guarded = F.when(column == NULL_TEXT, F.raise_error(message).cast("string")).otherwise(column)
    return guarded.alias(field.name)
