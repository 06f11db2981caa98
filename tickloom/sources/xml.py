"""XML ticks and codes to bronze."""
from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import instant
from ..schemas import CODE_XML, TICK_XML
from ..session import materialise
from .files import below
from .tables import append, append_or_create


def detect_row_tag(spark: SparkSession, path: str) -> str:
    """Name of the first element below the root, outside comments, CDATA sections, declarations and instructions.

    Only the head of the file is read, in pieces that end at '>'.
    """
    pieces = spark.read.option("lineSep", ">").text(path).select("value")
    wanted = 64
    while True:
        read = [r.value + ">" for r in pieces.head(wanted)]
        head = re.sub(r"<!--.*?(-->|$)|<!\[CDATA\[.*?(\]\]>|$)|<[!?][^>]*>", "", "".join(read), flags=re.S)
        starts = re.findall(r"<([A-Za-z_:][^\s/>]*)[^>]*>", head)
        if len(starts) >= 2:
            return starts[1]
        if len(read) < wanted:
            raise ValueError(f"no row element in {path}")
        wanted *= 8


def read_xml(spark: SparkSession, paths: str | list[str], row_tag: str, schema: str) -> DataFrame:
    """Elements `row_tag` as typed rows; a field that does not parse becomes NULL and the row's text is kept.

    Fields are read as text and cast one by one, because the typed reader gives up the rest of a row after its first
    bad field.
    """
    fields = T.StructType.fromDDL(schema).fields
    texts = ", ".join(f"`{f.name}` STRING" for f in fields)
    rows = (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .schema(f"{texts}, _corrupt_record STRING")
        .load(paths)
    )
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]
    failed = [F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in fields]
    text = F.when(F.array_contains(F.array(*failed), True), F.to_json(F.struct(*[f.name for f in fields])))
    return rows.select(*typed, F.coalesce("_corrupt_record", text).alias("_corrupt_record"))


def add_provenance(df: DataFrame, side: str, ingest_ts: dt.datetime | None = None, root: str | None = None) -> DataFrame:
    """Source file, option side and one ingest time for the whole run; apply directly to a file scan.

    The file's name is its path below `root`, which tells files of one name in several folders apart; bare without a root.
    """
    stamp = F.current_timestamp() if ingest_ts is None else instant(ingest_ts)
    name = F.col("_metadata.file_name") if root is None else below(df.sparkSession, root, F.col("_metadata.file_path"))
    return df.withColumns({"src_file": name, "side": F.lit(side), "ingest_ts": stamp})


def bronze_rows(
    spark: SparkSession, call: str, put: str, schema: str, ingest_ts: dt.datetime | None = None, root: str | None = None
) -> DataFrame:
    """Both sides of one kind of file, by column name. Each file has its own row tag."""
    sides = [
        add_provenance(read_xml(spark, path, detect_row_tag(spark, path), schema), side, ingest_ts, root)
        for path, side in ((call, "CALL"), (put, "PUT"))
    ]
    return sides[0].unionByName(sides[1])


def ingest_bronze(
    spark: SparkSession,
    tick_call: str,
    tick_put: str,
    code_call: str,
    code_put: str,
    database: str,
    ingest_ts: dt.datetime | None = None,
    root: str | None = None,
) -> None:
    """Append the ticks and codes of four files to `bronze_ticks` and `bronze_codes`.

    A row with a field that does not parse keeps its other fields there, and its text goes to `bronze_quarantine` too. Files
    are parsed once, into a stored table split by whether the row is damaged.
    """
    for kind, call, put, schema in (("ticks", tick_call, tick_put, TICK_XML), ("codes", code_call, code_put, CODE_XML)):
        parsed = bronze_rows(spark, call, put, schema, ingest_ts, root)
        rows = materialise(parsed.withColumn("damaged", F.col("_corrupt_record").isNotNull()), f"staged-{kind}", ["damaged"])
        append(rows.drop("_corrupt_record", "damaged"), f"{database}.bronze_{kind}")
        damaged = rows.where("damaged").select(F.lit(kind).alias("kind"), "src_file", "side", "ingest_ts", "_corrupt_record")
        append_or_create(damaged, f"{database}.bronze_quarantine")
