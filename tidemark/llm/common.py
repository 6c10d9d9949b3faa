"""Shared helpers: whole-text column functions in Arrow batches, and tables kept in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Texts are handed to Python functions in slices of about this many characters, so memory does not follow batch sizes.
SLICE_CHARS = 2_000_000

#: A side of a join is broadcast only if its content has been measured and is at most this many bytes.
BROADCAST_BYTES = 32 << 20

#: White space of the word rules: space and the five ASCII controls from tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """The cluster's shared folder; a local session that names none gets a temporary folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here, and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def content_bytes(df: DataFrame) -> int:
    """Bytes of all rows written out as text, one number from a distributed sum. Files say less: they compress well."""
    return df.select(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0


def small(df: DataFrame) -> DataFrame:
    """A kept table with a broadcast hint if its measured content allows it; else as it is, to be joined by shuffle."""
    return F.broadcast(df) if content_bytes(df) <= BROADCAST_BYTES else df


def all_of(df: DataFrame) -> Column:
    """Every column as one struct, so that no name can clash with a working column."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def add_columns(
    df: DataFrame, text: str, made: StructType, start: Callable[[], Callable[[list[str]], list[list]]]
) -> DataFrame:
    """``df`` with the columns ``made``, computed from whole texts (null: empty) in the tasks that hold the rows.

    ``start`` runs once per task and returns a function from a list of texts to one list of values per new column.
    Existing columns of the same names are replaced.
    """
    packed = df.select(all_of(df).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    schema = StructType([packed.schema["row"], StructField("made", made)])
    kinds = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal kinds
        if kinds is None:
            from pyspark.sql.pandas.types import to_arrow_schema

            kinds = to_arrow_schema(made)
        compute = start()
        for batch in batches:
            rows, texts = batch.column(0), batch.column(1)
            for low, high in slices(texts):
                values = compute(texts.slice(low, high - low).to_pylist())
                columns = [pa.array(v, type=k.type) for v, k in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(low, high - low), pa.StructArray.from_arrays(columns, fields=list(kinds))],
                    names=["row", "made"],
                )

    out = packed.mapInArrow(run, schema)
    kept = [c for c in df.columns if c not in made.names]
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], *[F.col("made").getField(c).alias(c) for c in made.names])


def slices(texts: pa.Array, most: int = SLICE_CHARS, length: str = "utf8_length") -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` characters (bytes with the length ``binary_length``); one very long text is a range of its own."""
    import pyarrow.compute as pc

    low = total = 0
    for i, n in enumerate(pc.call_function(length, [texts]).to_pylist()):
        if i > low and total + n > most:
            yield low, i
            low = i
            total = 0
        total += n
    if len(texts) > low:
        yield low, len(texts)


def sha256_of_strings(values: Column, by: str) -> Column:
    return F.sha2(F.array_join(values, by), 256)
