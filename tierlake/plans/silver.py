"""Bronze to Silver from a declarative specification, and the bundled models."""

from __future__ import annotations

import io
from collections.abc import Mapping, Sequence
from contextlib import redirect_stdout
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierlake import tables
from tierlake.names import Layers, identifier, run_day
from tierlake.operators.filters import apply_filters, day_literal, on_date
from tierlake.operators.joins import equal_pairs, join_on, join_type
from tierlake.operators.quality import require_passing, run_tests
from tierlake.operators.sequences import day_gap
from tierlake.plans.batch_tests import run_batch_tests
from tierlake.sources.instruments import SEGMENTS
from tierlake.sources.market import RECORD, SNAPSHOT_KEY, TICK_KEY

STRATEGIES = ("overwrite", "append", "insert_overwrite", "merge")

# Cast names of the mapper that Spark spells differently.
CAST_NAMES = {"varchar": "string", "integer": "int", "real": "float"}


def read_source(spark: SparkSession, source: Mapping) -> DataFrame:
    parts = [identifier(part, "table") for part in str(source.get("fqn") or "").split(".")]
    return spark.table(".".join(f"`{part}`" for part in parts))


@dataclass(frozen=True)
class Source:
    """One source of a specification, under the alias that expressions use."""

    alias: str
    dated: bool
    how: str
    pairs: tuple[tuple[str, str], ...]
    spec: Mapping


@dataclass(frozen=True)
class Projection:
    """One output column: a Spark SQL expression, its name, and the type it is cast to."""

    expression: str
    name: str
    kind: str | None

    def column(self) -> Column:
        value = F.expr(self.expression)
        return (value.cast(self.kind) if self.kind else value).alias(self.name)


def _text(part: Mapping, key: str) -> str:
    return str(part.get(key) or "").strip()


def parse_sources(spec: Mapping) -> list[Source]:
    """The sources, with names for those that have none: src, src2, src3."""
    parsed = []
    for number, part in enumerate(spec.get("sources") or (), 1):
        alias = identifier(_text(part, "alias") or ("src" if number == 1 else f"src{number}"), "alias")
        joined = number > 1
        parsed.append(Source(
            alias, bool(part.get("snapshot_date")), join_type(part.get("join_type")) if joined else "",
            tuple(equal_pairs(part.get("join_conds"))) if joined else (), part))
    if not parsed:
        raise ValueError("A specification without sources cannot be built")
    return parsed


def parse_columns(spec: Mapping) -> list[Projection]:
    """The output columns that have an expression; none means all columns."""
    parsed = []
    for part in spec.get("columns") or ():
        expression = _text(part, "source_expr")
        if expression:
            name = identifier(_text(part, "target") or expression.rpartition(".")[2], "column name")
            kind = _text(part, "cast").lower()
            parsed.append(Projection(expression, name, CAST_NAMES.get(kind, kind) or None))
    return parsed


def join_sources(spark: SparkSession, sources: Sequence[Source]) -> list[DataFrame]:
    """Chain the sources from left to right. The rows are the union of the list, which has
    more than one frame only after a full join."""
    frames = [read_source(spark, sources[0].spec).alias(sources[0].alias)]
    before = [sources[0].alias]
    for source in sources[1:]:
        right = read_source(spark, source.spec).alias(source.alias)
        if len(frames) > 1:
            # One frame again, with every alias as a struct, so later joins run once.
            frames = [_united(frames, before)]
        frames = join_on(frames[0], right, source.alias, source.pairs, source.how)
        if source.how not in ("left_semi", "left_anti"):
            before.append(source.alias)
    return frames


def _united(frames: Sequence[DataFrame], aliases: Sequence[str]) -> DataFrame:
    """The rows of the frames in one: a struct column for each alias, whose fields resolve as before."""
    packed = [
        frame.select(*(F.struct(f"{alias}.*").alias(alias) for alias in aliases)) for frame in frames]
    return reduce(DataFrame.union, packed)


def build_silver(spark: SparkSession, spec: Mapping, day: str | None = None) -> DataFrame:
    """The frame of a specification: sources joined, filtered, projected.

    ``{target_table, strategy, sources: [{fqn, alias, snapshot_date, join_type, join_conds:
    [{lh, rh}]}], columns: [{source_expr, target, cast}], filters: [{col, op, val}]}``.
    Snapshot filters apply after the joins, as in a WHERE clause; Catalyst moves them into
    the pruned scans. Expressions are Spark SQL. After a full join that another join follows,
    expressions name columns with their alias.
    """
    sources, columns = parse_sources(spec), parse_columns(spec)
    parts = []
    for frame in join_sources(spark, sources):
        for source in sources:
            if source.dated:
                frame = frame.filter(F.col(f"{source.alias}.snapshot_date") == day_literal(day))
        frame = apply_filters(frame, spec.get("filters") or [])
        parts.append(frame.select(*(c.column() for c in columns)) if columns else frame)
    return reduce(DataFrame.union, parts)


def explain_silver(spark: SparkSession, spec: Mapping, day: str | None = None) -> str:
    """The plan of a specification as text."""
    text = io.StringIO()
    with redirect_stdout(text):
        build_silver(spark, spec, day).explain("formatted")
    return text.getvalue()


def write_silver(spark: SparkSession, layers: Layers, name: str, df: DataFrame, strategy: str = "overwrite",
                 *, keys: Sequence[str] = (), delete_date: str | None = None,
                 one_day: bool = False, stage: bool = False, verify: str | None = None,
                 keep_index: bool = False) -> int:
    """Write a model. Tables with a ``snapshot_date`` are partitioned by it.

    ``insert_overwrite`` replaces the dates that arrive, keeps rows without a date, and with
    ``delete_date`` clears that date even when nothing arrives for it. ``merge`` updates by
    key; ``stage`` writes its source out first. ``one_day``: all rows have one date, so the
    write needs no shuffle. ``verify`` compares what was written with what is then there, by
    ``rows`` or by ``values`` (``append``: by rows). ``keep_index``: see ``tables.append``.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"Silver is written by the strategy {', '.join(STRATEGIES)}, not {strategy!r}")
    table = layers.resolve(name, "silver")
    layers.ensure(spark, "silver")
    parts = ["snapshot_date"] if "snapshot_date" in df.columns and len(df.columns) > 1 else []
    if strategy == "insert_overwrite" and not parts:
        raise ValueError("insert_overwrite needs a snapshot_date column")
    if strategy == "merge":
        return tables.merge_by_key(spark, table, df, keys, parts, stage=stage, verify=verify, rebalance=not one_day)
    if strategy == "overwrite" or not tables.exists(spark, table):
        return tables.replace(spark, table, df, parts, allow_empty=True, rebalance=not one_day, verify=verify)
    if strategy == "append":
        return tables.append(spark, table, df, verify=bool(verify), keep_index=keep_index)
    seen = Observation()
    if delete_date is not None:
        arrives = F.col("snapshot_date") == F.lit(run_day(delete_date))
        df = df.observe(seen, F.count_if(arrives).alias("rows"))
    undated = tables.read(spark, table).filter("snapshot_date IS NULL").select(*df.columns)
    count = tables.overwrite_partitions(spark, table, df.unionByName(undated), rebalance=not one_day,
                                        verify=verify)
    if delete_date is not None and seen.get["rows"] == 0:
        tables.drop_partition(spark, table, {"snapshot_date": run_day(delete_date)})
    return count


def run_silver(spark: SparkSession, layers: Layers, spec: Mapping, run_date: str | None = None,
               tests: Sequence[Mapping] = (), verify: str | None = "rows", *, whole: bool = True) -> int:
    """Build a specification, write it by its strategy, verify the write, then test the written table.

    With ``whole=False`` the tests after an append or a merge leave out the history that earlier runs have
    tested (``run_batch_tests``); the rows to write are then stored once, beside the table.
    """
    name = identifier((spec.get("target_table") or "").strip(), "target_table")
    strategy = (spec.get("strategy") or "overwrite").strip()
    table, keys = layers.resolve(name, "silver"), spec.get("keys") or ()
    built = build_silver(spark, spec, run_date)
    if tests and not whole and strategy in ("append", "merge") and tables.exists(spark, table):
        with tables.staged(spark, table, built) as batch:
            count = write_silver(spark, layers, name, batch, strategy, keys=keys, verify=verify, keep_index=True)
            require_passing(run_batch_tests(spark, table, batch, tests))
        return count
    count = write_silver(
        spark, layers, name, built, strategy, keys=keys,
        delete_date=run_date if strategy == "insert_overwrite" else None,
        one_day=any(source.get("snapshot_date") for source in spec["sources"]),
        stage=len(spec["sources"]) > 1, verify=verify)
    if tests:
        require_passing(run_tests(tables.read(spark, table), tests))
    return count


def materialise(spark: SparkSession, layers: Layers, name: str, df: DataFrame, kind: str = "table") -> None:
    """A model as a session view (staging) or as a Silver table (mart)."""
    if kind == "view":
        df.createOrReplaceTempView(identifier(name))
    elif kind == "table":
        write_silver(spark, layers, name, df)
    else:
        raise ValueError(f"Unknown materialisation: {kind!r}")


# --- bundled models ---------------------------------------------------------------

SNAPSHOT_KEYS = (*SNAPSHOT_KEY, "snapshot_date")

# Data tests of the two market models.
SNAPSHOT_TESTS = (
    {"test": "unique_combination", "columns": SNAPSHOT_KEYS},
    *({"test": "not_null", "column": c} for c in SNAPSHOT_KEYS),
)
TICK_TESTS = (
    {"test": "not_null", "column": "event_id"}, {"test": "unique", "column": "event_id"},
    {"test": "not_null", "column": "exchange_segment"},
    {"test": "accepted_values", "column": "exchange_segment", "values": SEGMENTS},
    *({"test": "not_null", "column": c} for c in ("security_id", "received_at", "trading_date")),
)


def market_snapshot_model(spark: SparkSession, layers: Layers, bronze: str, day: str | None = None,
                          name: str = "nse_market_snapshot") -> int:
    """Daily instrument snapshots; a replay updates the same instrument and date."""
    rows = on_date(tables.read(spark, layers.resolve(bronze, "bronze")), "snapshot_date", day)
    count = write_silver(spark, layers, name, rows, "merge", keys=SNAPSHOT_KEYS, one_day=True)
    written = on_date(tables.read(spark, layers.resolve(name, "silver")), "snapshot_date", day)
    require_passing(run_tests(written, SNAPSHOT_TESTS))
    return count


def live_ticks_model(spark: SparkSession, layers: Layers, bronze: str, day: str | None = None,
                     name: str = "nse_live_ticks") -> int:
    """Live events, one per event id, whatever minute or day is replayed."""
    rows = on_date(tables.read(spark, layers.resolve(bronze, "bronze")), "snapshot_date", day)
    rows = rows.select(*RECORD, "snapshot_date")
    count = write_silver(spark, layers, name, rows, "merge", keys=TICK_KEY)
    # Only rows with a key of this batch can have changed: history is not tested again.
    table, ids = layers.resolve(name, "silver"), rows.select(*TICK_KEY).distinct()
    written = tables.read(spark, table).filter(tables.holding(spark, table, ids, TICK_KEY))
    touched = written.join(ids, list(TICK_KEY), "left_semi")
    require_passing(run_tests(touched, TICK_TESTS))
    return count


def state_day_gap_model(snapshot: DataFrame) -> DataFrame:
    """Days from each state's date to its next one, as ``(s_fips, d_diff)``.

    The rows of a state are put in order once, instead of joining all its rows with each
    other.
    """
    others = [c for c in snapshot.columns if c not in ("state_fips", "date")]
    snapshot = snapshot.withColumn("date", F.col("date").cast("timestamp"))
    return day_gap(snapshot, "state_fips", "date", others).select(
        F.col("state_fips").alias("s_fips"), "d_diff")
