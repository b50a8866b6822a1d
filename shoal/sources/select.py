"""SQL over one object: CSV, JSON or Parquet in, rows or CSV and JSON lines out.

The object is bound to the name ``S3Object`` and Spark runs the statement: filters and columns reach the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

VIEW = "S3Object"


#: Declared compressions, and the ends of names by which Spark's readers choose a codec.
_ENDS = {"NONE": None, "GZIP": ".gz", "BZIP2": ".bz2"}


def _checked(spark: SparkSession, path: str, compression: str) -> None:
    """Readers go by names of files, so a declaration that disagrees with them is an error, not garbage. NONE declares nothing."""
    if compression not in _ENDS:
        raise ValueError(f"unknown compression: {compression}")
    if end := _ENDS[compression]:
        other = spark.read.format("binaryFile").load(path).select("path").where(~F.col("path").endswith(end)).first()  # names only, no content
        if other:
            raise ValueError(f"{other['path']} is declared {compression}, which needs a name that ends with {end}")


@dataclass(frozen=True)
class CsvInput:
    header: str = "USE"  # USE: names; IGNORE: skipped, columns are _1, _2, ...; NONE: there is none
    field_delimiter: str = ","
    record_delimiter: str | None = None
    quote: str = '"'
    quote_escape: str = '"'
    comments: str | None = None
    quoted_record_delimiter: bool = True
    compression: str = "NONE"

    def read(self, spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
        if self.header not in ("USE", "IGNORE", "NONE"):
            raise ValueError(f"unknown header mode: {self.header}")
        _checked(spark, path, self.compression)
        reader = spark.read.option("sep", self.field_delimiter).option("quote", self.quote).option("escape", self.quote_escape).option("multiLine", self.quoted_record_delimiter).option("header", self.header != "NONE")
        for name, value in (("lineSep", self.record_delimiter), ("comment", self.comments)):
            if value is not None:
                reader = reader.option(name, value)
        df = (reader.schema(schema) if schema else reader).csv(path)
        return df if self.header == "USE" else df.toDF(*[f"_{i + 1}" for i in range(len(df.columns))])


@dataclass(frozen=True)
class JsonInput:
    kind: str = "LINES"  # or DOCUMENT
    compression: str = "NONE"

    def read(self, spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
        if self.kind not in ("LINES", "DOCUMENT"):
            raise ValueError(f"unknown JSON type: {self.kind}")
        _checked(spark, path, self.compression)
        reader = spark.read.option("multiLine", self.kind == "DOCUMENT")
        return (reader.schema(schema) if schema else reader).json(path)


@dataclass(frozen=True)
class ParquetInput:
    def read(self, spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)


@dataclass(frozen=True)
class CsvOutput:
    field_delimiter: str = ","
    quote: str = '"'
    quote_escape: str = '"'
    quote_all: bool = False

    def lines(self, df: DataFrame) -> DataFrame:
        options = {"sep": self.field_delimiter, "quote": self.quote, "escape": self.quote_escape, "quoteAll": str(self.quote_all).lower()}
        return df.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), options).alias("record"))


@dataclass(frozen=True)
class JsonOutput:
    def lines(self, df: DataFrame) -> DataFrame:
        return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("record"))


_PAIRS = ((CsvInput, CsvOutput), (CsvInput, JsonOutput), (JsonInput, JsonOutput), (ParquetInput, CsvOutput), (ParquetInput, JsonOutput))


@dataclass
class SelectRequest:
    """A statement over an input, with an output for its records. Five pairs of formats are allowed."""

    expression: str
    input: CsvInput | JsonInput | ParquetInput
    output: CsvOutput | JsonOutput = field(default_factory=JsonOutput)

    def __post_init__(self):
        statement = self.expression.strip()
        if not statement:
            raise ValueError("the expression is empty")
        if not re.match(r"(?is)select\b", statement):
            raise ValueError("only SELECT is allowed")
        if (type(self.input), type(self.output)) not in _PAIRS:
            raise ValueError("this pair of formats isn't allowed")
        named = {x.strip("`").split(".")[0].lower() for x in re.findall(r"(?is)\b(?:from|join)\s+([`\w.]+)", re.sub(r"'(?:[^'\\]|\\.|'')*'", "''", statement))}
        if named - {VIEW.lower()}:
            raise ValueError(f"only {VIEW} can be read")

    def rows(self, spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
        return self.over(self.input.read(spark, path, schema))

    def over(self, df: DataFrame) -> DataFrame:
        """The statement over a relation that is read already."""
        statement = re.sub(r"(?i)\bS3Object\b", "{S3Object}", self.expression.replace("{", "{{").replace("}", "}}"))
        return df.sparkSession.sql(statement, **{VIEW: df})

    def records(self, spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
        """The result as text records of the output's format."""
        return self.output.lines(self.rows(spark, path, schema))


def with_progress(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Counts the records and bytes returned while the result is computed."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("records_returned"), F.coalesce(F.sum(F.octet_length("record") + 1), F.lit(0)).alias("bytes_returned")), seen


def scan_range(spark: SparkSession, path: str, start: int, end: int) -> DataFrame:
    """(offset, record): lines of an uncompressed text whose first byte is in [start, end].

    Blocks of a file are read by tasks of their own. A line's offset is what the file's earlier blocks hold, a sum for each, and what its own block holds before it.
    A mark of byte order at the start of a file isn't counted.
    """
    if not 0 <= start <= end:
        raise ValueError("a scan range has both ends")
    text = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line")).where(F.col("block") <= end)
    sizes = text.groupBy("file", "block").agg(F.sum(F.octet_length("line") + 1).alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    begins = sizes.select("file", "block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("begin"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last = 0, None  # lines of a block come in their order
        for batch in batches:
            if not batch.num_rows:
                continue
            size = pc.binary_length(batch.column(2)).to_numpy().astype(np.int64) + 1
            file, block = batch.column(0).dictionary_encode().indices.to_numpy(), batch.column(1).to_numpy()
            new = np.concatenate([[True], (file[1:] != file[:-1]) | (block[1:] != block[:-1])])
            upto = np.cumsum(size) - size
            group = np.cumsum(new) - 1
            local = upto - upto[np.flatnonzero(new)][group]
            if (batch.column(0)[0], batch.column(1)[0]) == last:
                local[group == 0] += at
            at, last = int(local[-1] + size[-1]), (batch.column(0)[-1], batch.column(1)[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(local), batch.column(2)], names=["file", "block", "place", "line"])

    lines = text.mapInArrow(placed, "file string, block bigint, place bigint, line binary")
    offset = F.col("begin") + F.col("place")
    return lines.join(begins, ["file", "block"]).where(offset.between(start, end)).select(offset.alias("offset"), F.col("line").cast("string").alias("record"))
