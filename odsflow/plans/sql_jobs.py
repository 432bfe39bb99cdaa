"""Jobs made of SQL text: ordered steps and parametrised files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from odsflow.sources import partitions


@contextmanager
def _variables(spark: SparkSession, values: Mapping[str, object]):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Comments (a hint is none), quoted text, a statement's end, words, and whatever lies between.
_TOKENS = re.compile(
    r"""(?P<comment>--[^\n]*|/\*(?!\+).*?\*/)|(?P<quoted>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|`[^`]*`)"""
    r"""|(?P<end>;)|(?P<word>\w+)|(?P<other>.)""",
    re.DOTALL,
)
_BLOCKS = {"IF", "WHILE", "LOOP", "REPEAT", "FOR"}


def statements(text: str) -> list[str]:
    """The statements of a script, without comments; ``;`` in quotes ends none.

    A compound statement, ``BEGIN`` to its ``END``, is one. Hints stay.
    """
    found, own = [], []
    depth, words = 0, []
    for token in _TOKENS.finditer(text):
        kind, part = token.lastgroup, token.group()
        if kind == "word":
            word = part.upper()
            # END IF and the like close what was not counted; a CASE ends with END, or END CASE.
            if word == "BEGIN" and (depth or not words) or word == "CASE" and depth and words[-1:] != ["END"]:
                depth += 1
            elif word == "END" and depth:
                depth -= 1
            elif word in _BLOCKS and words[-1:] == ["END"]:
                depth += 1
            words.append(word)
        if kind == "end" and not depth:
            found.append("".join(own))
            own, words = [], []
        else:
            own.append(" " if kind == "comment" else part)
    return [s.strip() for s in [*found, "".join(own)] if s.strip()]


def run_sql(spark: SparkSession, text: str, params: Mapping[str, object] | None = None) -> DataFrame:
    """Run one or several statements; the last one's result is returned, not yet computed.

    Values come in as named parameters (``:day``, ``IDENTIFIER(:tab)``) or as
    ``${hiveconf:day}`` variables; the latter are set for this call only. The
    first failing statement ends the run.
    """
    given = dict(params or {})
    result = None
    with _variables(spark, given):
        for statement in statements(text):
            result = spark.sql(statement, args=given)
    if result is None:
        raise ValueError("no statement to run")
    return result


def run_sql_file(spark: SparkSession, path: str, params: Mapping[str, object] | None = None) -> DataFrame:
    """Run the SQL file at ``path``: one file, or a folder that holds one."""
    texts = spark.read.text(path, wholetext=True).take(2)
    if len(texts) != 1:
        raise ValueError(f"{path} must hold one SQL file, and no more")
    return run_sql(spark, texts[0][0], params)


def _switch_table(spark: SparkSession, database: str, name: str, rows: DataFrame) -> None:
    """Let ``<database>.<name>`` be ``rows``: written whole beside it first, then exchanged in the catalog."""
    table = f"{database}.{name}"
    home = spark.sql(f"DESCRIBE DATABASE {database}").where("info_name = 'Location'").first()[1].rstrip("/")
    folder = partitions.new_run(f"{home}/{name}", "step")
    rows.write.parquet(folder)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=folder, source="parquet", schema=spark.read.parquet(folder).schema)


def run_steps(
    spark: SparkSession,
    steps: Sequence[tuple[str, str]],
    params: Mapping[str, object] | None = None,
    root: str | None = None,
    database: str | None = None,
) -> dict[str, DataFrame]:
    """Named queries in order, each visible to the later ones under its name.

    With ``root`` every step is written below ``<root>/<name>`` once and read back,
    with ``database`` it replaces the table ``<database>.<name>``; both keep
    lineages short and are what several readers of a step want. A step's rows
    are written to a new folder before anything of the last run goes, so a step that
    fails leaves that whole. Without either a step is a view. The first failing
    step ends the job.
    """
    given = dict(params or {})
    results = {}
    for name, sql in steps:
        with _variables(spark, given):
            rows = spark.sql(sql, args=given)
        if root:
            folder = f"{root}/{name}/{uuid.uuid4().hex}"
            rows.write.parquet(folder)
            rows = spark.read.parquet(folder)
        elif database:
            _switch_table(spark, database, name, rows)
            rows = spark.table(f"{database}.{name}")
        rows.createOrReplaceTempView(name)
        results[name] = rows
    return results
