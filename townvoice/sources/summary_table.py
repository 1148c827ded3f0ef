"""Summaries by period, merged from one delivery of rows after the other.

    days/day={date}/slot={s}     the periods of a day
    late/version={v}             rows that came after their period was closed
    journal/side={0|1}           what belongs to the table

A delivery is a version. It adds its rows' figures to the periods they belong to and rewrites
only the days these lie in. A period is closed once a row ``lateness`` younger than its end has
come in an earlier delivery; rows that come later are counted and kept apart, never added. So
only days with open periods are ever read again. Slots are used in turn, nothing is deleted, and
a version without a journal row is not seen. One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampNTZType

from ..lexicon import DEFAULT_LEXICON, Lexicon
from ..operators.summary import mention_totals, sentiment_metrics
from ..schemas import POSTS_SCHEMA
from ..session import materialize, scratch

SLOTS = 3
ANEW = 50  # versions between two whole journals
FACTS = (
    "kind string, generation bigint, version bigint, origin string, batch bigint, day string, slot int, "
    "youngest string, late bigint, rows bigint"
)


@dataclass
class Journal:
    generation: int = 0
    days: dict[str, list[tuple[int, int]]] = field(default_factory=dict)  # day -> (version, slot)
    versions: dict[int, tuple] = field(default_factory=dict)  # version -> origin, batch, youngest row, late rows, rows

    def latest(self) -> int:
        return max([0, *self.versions])

    def youngest(self, before: int) -> datetime | None:
        found = [seen for v, (_, _, seen, _, _) in self.versions.items() if v < before and seen]
        return datetime.fromisoformat(max(found)) if found else None

    def slot(self, day: str, before: int) -> int | None:
        return max(((v, s) for v, s in self.days.get(day, []) if v < before), default=(0, None))[1]


def journal(spark: SparkSession, path: str) -> Journal:
    try:
        facts = spark.read.schema(FACTS).option("ignoreMissingFiles", "true").json(f"{path}/journal").collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return Journal()
    found = Journal(max([f.generation for f in facts if f.kind == "table"], default=0))
    for f in facts:
        if f.generation == found.generation and f.kind == "day":
            found.days.setdefault(f.day, []).append((f.version, f.slot))
        elif f.generation == found.generation and f.kind == "version":
            found.versions[f.version] = (f.origin, f.batch, f.youngest, f.late, f.rows)
    return found


def _write_facts(spark: SparkSession, path: str, generation: int, facts: list[dict], mode: str) -> None:
    names = [part.split()[0] for part in FACTS.split(", ")]
    rows = [tuple({"generation": generation, **fact}.get(name) for name in names) for fact in facts]
    spark.createDataFrame(rows, FACTS).coalesce(1).write.mode(mode).json(f"{path}/journal/side={generation % 2}")


def _next_version(state: Journal, origin: str, batch: int | None) -> int:
    own = [(v, of) for v, (by, of, *_) in state.versions.items() if by == origin] if batch is not None else []
    version, last = max(own, default=(0, -1))
    if batch is None or batch > last:
        return state.latest() + 1
    if last > batch or version != state.latest():
        raise ValueError(f"batch {batch} was applied before later versions")
    return version


def summary_schema(spark: SparkSession, lexicon: Lexicon) -> StructType:
    empty = spark.createDataFrame([], POSTS_SCHEMA)
    figures = empty.agg(*sentiment_metrics(), *mention_totals(empty, lexicon)).schema
    return StructType([StructField("period", TimestampNTZType()), *figures.fields])


def merge_summary(spark: SparkSession, path: str, rows: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON, lateness: str = "10 minutes",
                  every: str = "5 minutes", origin: str = "job", batch: int | None = None) -> int:
    """Add a delivery of rows; returns how many came late.

    Each task sends one partial row a period. With an ``origin`` and a ``batch`` number a
    delivery that comes again counts once. Rows without a time belong to no period.
    """
    state = journal(spark, path)
    if not state.generation:
        state.generation = 1
        _write_facts(spark, path, 1, [{"kind": "table"}], "overwrite")
    version = _next_version(state, origin, batch)
    youngest = state.youngest(version)
    period = F.window("checked_at", every)
    with scratch(f"{path}/scratch"):
        timed = rows.filter(F.col("checked_at").isNotNull())
        sums = timed.groupBy(period.alias("w")).agg(*sentiment_metrics(), *mention_totals(timed, lexicon), F.max("checked_at").alias("_youngest"))
        figures = [name for name in sums.columns if name not in ("w", "_youngest")]
        closed = F.lit(False) if youngest is None else F.col("w.end") <= F.lit(youngest.isoformat(sep=" ")).cast("timestamp_ntz") - F.expr(f"INTERVAL {lateness}")
        new = materialize(sums.select(
            F.col("w.start").alias("period"), *figures, "_youngest", closed.alias("_late"),
            F.date_format("w.start", "yyyy-MM-dd").alias("day")), "delivery")
        about = new.agg(F.max("_youngest").cast("string").alias("youngest"), F.sum(F.when(F.col("_late"), F.col("total_posts_comments"))).alias("late"),
                        F.sum("total_posts_comments").alias("rows")).first()
        if about.late:
            # a second look at the delivery, where there is something to keep apart
            placed = timed.select("*", period.alias("_w")).withColumn("period", F.col("_w.start"))
            late = placed.join(new.filter("_late").select("period"), "period", "left_semi").select(*timed.columns)
            late.write.mode("overwrite").parquet(f"{path}/late/version={version}")
        on_time = new.filter("not _late")
        days = sorted(row.day for row in on_time.select("day").distinct().collect())
        slots = {day: state.slot(day, version) for day in days}
        merged = on_time.select("period", "day", *figures)
        paths = [f"{path}/days/day={day}/slot={slot}" for day, slot in slots.items() if slot is not None]
        if paths:
            stored = spark.read.schema(on_time.select("period", *figures).schema).parquet(*paths)
            merged = merged.unionByName(stored.withColumn("day", F.date_format("period", "yyyy-MM-dd")))
        merged = merged.groupBy("period", "day").agg(*[F.sum(name).alias(name) for name in figures])
        # a handful of days: the slots follow the journal
        next_slot = F.coalesce(*[F.when(F.col("day") == day, F.lit(0 if slot is None else (slot + 1) % SLOTS)) for day, slot in slots.items()], F.lit(0))
        if days:
            merged.withColumn("slot", next_slot).repartition("day").write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("day", "slot").parquet(f"{path}/days")
    facts = [{"kind": "day", "version": version, "day": day, "slot": 0 if slot is None else (slot + 1) % SLOTS} for day, slot in slots.items()]
    facts.append({"kind": "version", "version": version, "origin": origin, "batch": batch, "youngest": about.youngest, "late": about.late or 0, "rows": about.rows or 0})
    _write_facts(spark, path, state.generation, facts, "append")
    if version % ANEW == 0:
        _anew(spark, path)
    return about.late or 0


def _anew(spark: SparkSession, path: str) -> None:
    """The whole journal on its other side: each day's last two slots, the last versions."""
    state = journal(spark, path)
    facts = [{"kind": "table"}]
    facts += [{"kind": "day", "version": v, "day": day, "slot": s} for day, slots in state.days.items() for v, s in sorted(slots)[-2:]]
    youngest = state.youngest(state.latest() + 1)
    for version in sorted(state.versions)[-2:]:
        origin, batch, seen, late, rows = state.versions[version]
        facts.append({"kind": "version", "version": version, "origin": origin, "batch": batch, "youngest": seen, "late": late, "rows": rows})
    # what earlier versions held together, as a version before them
    earlier = sorted(state.versions)[:-2]
    if earlier:
        facts.append({
            "kind": "version", "version": earlier[-1], "origin": state.versions[earlier[-1]][0], "batch": state.versions[earlier[-1]][1],
            "youngest": max([state.versions[v][2] for v in earlier if state.versions[v][2]], default=youngest and youngest.isoformat(sep=" ")),
            "late": sum(state.versions[v][3] for v in earlier), "rows": sum(state.versions[v][4] for v in earlier)})
    _write_facts(spark, path, state.generation + 1, facts, "overwrite")


def read_summary(spark: SparkSession, path: str, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """``period`` and figures of every period so far, open ones included."""
    state = journal(spark, path)
    paths = [f"{path}/days/day={day}/slot={state.slot(day, state.latest() + 1)}" for day in state.days]
    schema = summary_schema(spark, lexicon)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def late_rows(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """How many rows came late, and the rows, with the ``version`` they came in."""
    state = journal(spark, path)
    total = sum(late for _, _, _, late, _ in state.versions.values())
    if not total:
        return 0, spark.createDataFrame([], StructType([*POSTS_SCHEMA.fields, StructField("version", IntegerType())]))
    return total, spark.read.schema(POSTS_SCHEMA).parquet(f"{path}/late").filter(F.col("version") <= state.latest())
