"""Changed rows merged into a stored history chain as they arrive.

Beside the chain lie the changes of every batch, ``<chain>_changes/rows``, and a
mark for each batch that has been merged, ``<chain>_changes/done``. A batch that
is given again, because its stream was cut off, overwrites its own rows and
replays the same days; one that has its mark changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from odsflow.operators.chain import CHAIN, ChainLayout
from odsflow.operators.chain_table import ChainRun, load_chain_range
from odsflow.operators.latest import latest_per_key
from odsflow.sizing import settled
from odsflow.sources import partitions, paths

_STREAM, _BATCH = "_stream", "_batch"


def changes_home(spark: SparkSession, table: str) -> str:
    return f"{partitions.table_location(spark, table).split('_runs/')[0]}_changes"


def _days(spark: SparkSession, folder: str, day_col: str) -> list[str]:
    days = [unquote(n.split("=", 1)[1]) for n in paths.child_dirs(spark, folder)]
    if "__HIVE_DEFAULT_PARTITION__" in days:
        raise ValueError(f"a change without {day_col}")
    return days


def kept_changes(
    spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str], first: str, day_col: str
) -> DataFrame:
    """The newest change of each key and day, of ``first`` and later days, over all batches.

    Of rows that are equal in ``order`` the one of the later batch counts.
    """
    marks = [T.StructField(_STREAM, T.StringType()), T.StructField(_BATCH, T.LongType()), T.StructField(day_col, T.StringType())]
    fields = [f for f in schema.fields if f.name != day_col]
    found = spark.read.schema(T.StructType([*fields, *marks])).parquet(f"{changes_home(spark, table)}/rows")
    newest = latest_per_key(found.where(F.col(day_col) >= first), [*keys, day_col], [*order, _BATCH, _STREAM])
    return newest.drop(_BATCH, _STREAM)


def merge_batch(
    changes: DataFrame,
    batch: int,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    stream: str,
    day_col: str = "etl_dt",
    layout: ChainLayout = CHAIN,
) -> ChainRun | None:
    """Keep the changed rows of one batch and replay the chain from their earliest day on.

    A batch may hold several days, also days before some that are merged already.
    Returns None where the batch has been merged before, or is empty.
    """
    spark = changes.sparkSession
    home = changes_home(spark, table)
    mark = f"{home}/done/{stream}-{batch}"
    if paths.exists(spark, mark):
        return None
    folder = f"{home}/rows/{_STREAM}={stream}/{_BATCH}={batch}"
    changes.hint("rebalance", F.col(day_col)).write.mode("overwrite").partitionBy(day_col).parquet(folder)
    days = _days(spark, folder, day_col)
    run = None
    if days:
        first = min(days)
        kept = kept_changes(spark, table, changes.schema, keys, order, first, day_col)
        with settled(kept, "stream_changes") as newest:
            run = load_chain_range(spark, table, newest, keys, first, day_col, layout)
    paths.touch(spark, mark)
    return run


def merge_stream(
    spark: SparkSession,
    staged: str,
    schema: T.StructType,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    day_col: str = "etl_dt",
    layout: ChainLayout = CHAIN,
    max_files: int | None = None,
) -> StreamingQuery:
    """Merge every staged file not yet taken into the chain; returns the finished query.

    ``staged`` holds folders of parquet files of changed rows with their day in
    ``day_col``; ``order`` names the columns that tell the newer of two changes of
    a key and day. A second call takes only new files, and a call that was cut off
    is completed by the next one. Rows of a past day start a replay of that
    and all later days from the kept changes.
    """
    reader = spark.readStream.schema(schema).option("maxFileAge", "36500000d")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def merge(changes: DataFrame, batch: int) -> None:
        name = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        merge_batch(changes, batch, table, keys, order, name, day_col, layout)

    query = (
        reader.parquet(f"{staged.rstrip('/')}/*")
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
