"""The tracking table on storage: a base in hash buckets, changes on top, and a journal.

    base/of={buckets}/bucket={b}/slot={s}/pending={0|1}   all rows as of a bucket's last folding
    changes/slot={s}                                      rows that one version changed
    journal/side={0|1}                                    what belongs to the table

A version writes the rows it changes and nothing else, so bytes follow the hits, not the
table. Every ``FOLD_EVERY`` versions the changes are folded into the buckets they touch; other
buckets stay as they are. Rows still to be crawled lie apart (``pending``): a claim reads
these, and the changes. A journal row commits a version; rows without one are not seen.

Nothing is deleted and no file system is called: slots are used in turn and overwritten. A
bucket's last two foldings and the versions since are kept, so a reader of the table goes on
undisturbed for at least ``FOLD_EVERY`` versions, and the latest version can be written again.
One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.tracking import KEY, claim_pending, detail_refresh, failed_write_rollback, same_key, status_transition, tracking_upsert
from ..schemas import TRACKING_SCHEMA
from ..session import materialize, scratch

BUCKETS = 256  # aim at 100 MB of rows a bucket
FOLD_EVERY = 16
BASE_SLOTS = 3
CHANGE_SLOTS = 2 * FOLD_EVERY + 2
ROW_GROUP = 4 << 20  # bytes; the hits of one time often lie in a few files
FACTS = (
    "kind string, generation bigint, version bigint, origin string, batch bigint, buckets int, "
    "bucket int, slot int, waiting bigint, settled bigint, rows bigint"
)
NAMES = TRACKING_SCHEMA.names
VERSIONED = StructType([*TRACKING_SCHEMA.fields, StructField("_version", LongType())])


@dataclass
class Base:
    version: int
    slot: int
    waiting: int
    settled: int


@dataclass
class Journal:
    """What the journal says of a table: bounded by its buckets and the versions kept."""

    generation: int
    buckets: int
    bases: dict[int, list[Base]] = field(default_factory=dict)
    versions: dict[int, tuple[str, int, int]] = field(default_factory=dict)  # version -> origin, batch, rows

    def latest(self) -> int:
        return max([0, *self.versions])

    def folded(self, before: int | None = None) -> int:
        """The last version folded into the buckets (before a version)."""
        found = [base.version for bases in self.bases.values() for base in bases]
        return max([0, *(v for v in found if before is None or v < before)])

    def base(self, bucket: int, before: int | None = None) -> Base | None:
        found = [base for base in self.bases.get(bucket, []) if before is None or base.version < before]
        return max(found, key=lambda base: base.version, default=None)

    def changes(self, before: int | None = None) -> list[int]:
        first = self.folded(before)
        return sorted(v for v, (_, _, rows) in self.versions.items() if rows and v > first and (before is None or v < before))


def journal(spark: SparkSession, path: str) -> Journal | None:
    try:
        # only the side of the latest generation counts; the other one may be being replaced
        facts = spark.read.schema(FACTS).option("ignoreMissingFiles", "true").json(f"{path}/journal").collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    heads = [f for f in facts if f.kind == "table"]
    if not heads:
        return None
    head = max(heads, key=lambda f: f.generation)
    found = Journal(head.generation, head.buckets)
    for f in facts:
        if f.generation != head.generation:
            continue
        if f.kind == "base":
            found.bases.setdefault(f.bucket, []).append(Base(f.version, f.slot, f.waiting, f.settled))
        elif f.kind == "version":
            if found.versions.get(f.version, (f.origin, f.batch))[:2] != (f.origin, f.batch):
                raise ValueError(f"two writers made version {f.version} of {path}")
            found.versions[f.version] = (f.origin, f.batch, f.rows)
    return found


def _fact(**given) -> tuple:
    return tuple(given.get(part.split()[0]) for part in FACTS.split(", "))


def _write_generation(spark: SparkSession, path: str, state: Journal) -> None:
    """The whole journal anew, on the other side; from then on only this side counts."""
    rows = [_fact(kind="table", generation=state.generation, buckets=state.buckets)]
    for bucket, bases in state.bases.items():
        for base in sorted(bases, key=lambda base: base.version)[-2:]:
            rows.append(_fact(kind="base", generation=state.generation, version=base.version, bucket=bucket, slot=base.slot,
                              waiting=base.waiting, settled=base.settled))
    for version in sorted(state.versions)[FOLD_EVERY - CHANGE_SLOTS :]:
        origin, batch, changed = state.versions[version]
        rows.append(_fact(kind="version", generation=state.generation, version=version, origin=origin, batch=batch, rows=changed))
    spark.createDataFrame(rows, FACTS).coalesce(1).write.mode("overwrite").json(f"{path}/journal/side={state.generation % 2}")


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("platform", "url"), F.lit(buckets)).cast("int")


def waiting() -> Column:
    """Rows a claim may look at: all but UNCHANGED ones."""
    return ~F.coalesce(F.col("status") == "UNCHANGED", F.lit(False))


def newest(spark: SparkSession, path: str, versions: Iterable[int]) -> DataFrame | None:
    """The last state of every row that these versions changed."""
    paths = [f"{path}/changes/slot={version % CHANGE_SLOTS}" for version in versions]
    if not paths:
        return None
    rows = spark.read.schema(VERSIONED).parquet(*paths)
    last = F.max_by(F.struct(*[name for name in NAMES if name not in KEY]), "_version").alias("last")
    return rows.groupBy(*KEY).agg(last).select(*KEY, "last.*").select(*NAMES)


def read_table(spark: SparkSession, path: str, before: int | None = None, buckets: list[int] | None = None, pending: bool = False) -> DataFrame | None:
    """The table, or its state before a version; None if there is none.

    ``buckets`` reads only these, ``pending`` only rows still to be crawled. The base is not
    shuffled while the changed rows are few enough to be sent to it.
    """
    state = journal(spark, path)
    if state is None or (before is not None and state.folded(before) == 0 and not state.changes(before)):
        return None
    return _read(spark, path, state, before, buckets, pending)


def _read(spark: SparkSession, path: str, state: Journal, before: int | None, buckets: list[int] | None, pending: bool) -> DataFrame:
    paths = []
    for bucket in sorted(state.bases if buckets is None else buckets):
        base = state.base(bucket, before)
        if base:
            folder = f"{path}/base/of={state.buckets}/bucket={bucket}/slot={base.slot}"
            paths += [f"{folder}/pending={side}" for side, rows in ((1, base.waiting), (0, 0 if pending else base.settled)) if rows]
    reader = spark.read.schema(TRACKING_SCHEMA)
    base = reader.parquet(*paths) if paths else spark.createDataFrame([], TRACKING_SCHEMA)
    changed = newest(spark, path, state.changes(before))
    if changed is None:
        return base
    if buckets is not None:
        changed = changed.filter(bucket_of(state.buckets).isin(buckets))
    rest = base.alias("b").join(changed.select(*KEY).alias("c"), same_key("b", "c"), "left_anti")
    return rest.unionByName(changed.filter(waiting()) if pending else changed)


def seed_table(tracking: DataFrame, path: str, buckets: int | None = None) -> None:
    """Store a whole tracking table, with a number of buckets of its own if wanted."""
    spark = tracking.sparkSession
    state = journal(spark, path) or Journal(0, buckets or BUCKETS)
    # another number of buckets is another folder: nothing that readers use is overwritten
    fresh = Journal(state.generation, buckets or state.buckets, state.bases if buckets in (None, state.buckets) else {}, state.versions)
    version = fresh.latest() + 1
    fresh.versions[version] = ("seed", 0, 0)
    _fold(spark, path, fresh, tracking.select(*NAMES), version)


def _fold(spark: SparkSession, path: str, state: Journal, rows: DataFrame, version: int, touched: list[int] | None = None) -> None:
    """Write ``rows``, all that the ``touched`` buckets hold, to the buckets' next slots; None stands for a whole new table."""
    slots = {bucket: (state.base(bucket).slot + 1) % BASE_SLOTS for bucket in state.bases}
    # a row a bucket; buckets without a base begin in slot 0
    table = spark.createDataFrame([(b, slots.get(b, 0)) for b in range(state.buckets)], "bucket int, slot int")
    placed = (
        rows.withColumns({"of": F.lit(state.buckets), "bucket": bucket_of(state.buckets), "pending": waiting().cast("int"), "_version": F.lit(version)})
        .join(F.broadcast(table), "bucket")
    )
    parts = ["of", "bucket", "slot", "pending"]
    placed.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(f"{path}/base")
    written = spark.read.parquet(f"{path}/base").filter((F.col("of") == state.buckets) & (F.col("_version") == version))
    if touched is not None:
        written = written.filter(F.col("bucket").isin(touched))
    counts = written.groupBy("bucket", "slot").agg(F.sum("pending").alias("waiting"), F.sum(1 - F.col("pending")).alias("settled")).collect()
    bases = {} if touched is None else dict(state.bases)
    for row in counts:
        bases[row.bucket] = [*state.bases.get(row.bucket, []), Base(version, row.slot, row.waiting, row.settled)]
    _write_generation(spark, path, Journal(state.generation + 1, state.buckets, bases, state.versions))


def fold_table(spark: SparkSession, path: str) -> None:
    """Fold the changes into the buckets they touch."""
    state = journal(spark, path)
    changed = newest(spark, path, state.changes())
    if changed is None:
        return
    touched = sorted(row.bucket for row in changed.select(bucket_of(state.buckets).alias("bucket")).distinct().collect())
    _fold(spark, path, state, _read(spark, path, state, None, touched, False), state.latest(), touched)


def next_version(state: Journal, origin: str, batch: int | None) -> int:
    """The version a batch writes: its own again if it is replayed, else the next.

    A replay can only be of the latest version; anything older cannot be undone.
    """
    own = [(v, of) for v, (by, of, _) in state.versions.items() if by == origin] if batch is not None else []
    version, last = max(own, default=(0, -1))
    if batch is None or batch > last:
        return state.latest() + 1
    if last > batch or version != state.latest():
        raise ValueError(f"batch {batch} was applied before later versions; seed a new table")
    return version


def change_table(spark: SparkSession, path: str, keys: DataFrame, change: Callable[[DataFrame | None], DataFrame],
                 origin: str = "job", batch: int | None = None, buckets: int | None = None) -> DataFrame:
    """Apply ``change`` to the state of the rows with these ``keys``, and commit what it returns.

    Returns the changed rows. With an ``origin`` and a ``batch`` number, a batch that comes
    again starts from the state before its own version: it is applied once. Only buckets that
    hold a key are read. Intermediate tables go to one folder that each change overwrites.
    """
    with scratch(f"{path}/scratch"):
        state = journal(spark, path)
        if state is None:
            state = Journal(1, buckets or BUCKETS)
            _write_generation(spark, path, state)
        version = next_version(state, origin, batch)
        wanted = materialize(keys.select(*KEY).distinct(), "keys")
        touched = sorted(row.bucket for row in wanted.select(bucket_of(state.buckets).alias("bucket")).distinct().collect())
        known = _read(spark, path, state, version, touched, False)
        mine = known.alias("t").join(wanted.alias("k"), same_key("t", "k"), "left_semi")
        folder = f"{path}/changes/slot={version % CHANGE_SLOTS}"
        change(mine).select(*NAMES, F.lit(version).cast("bigint").alias("_version")).write.mode("overwrite").parquet(folder)
    written = spark.read.schema(VERSIONED).parquet(folder)
    fact = _fact(kind="version", generation=state.generation, version=version, origin=origin, batch=batch, rows=written.count())
    spark.createDataFrame([fact], FACTS).coalesce(1).write.mode("append").json(f"{path}/journal/side={state.generation % 2}")
    if version - state.folded() >= FOLD_EVERY:
        fold_table(spark, path)
    return written.drop("_version")


def upsert_table(spark: SparkSession, path: str, hits: DataFrame, threshold: int = 100, rule: str = "literal", origin: str = "job",
                 batch: int | None = None, buckets: int | None = None) -> DataFrame:
    """:func:`~townvoice.operators.tracking.tracking_upsert` on the stored table. The hits are read once."""
    with scratch(f"{path}/scratch"):
        stored = materialize(hits, "hits", ROW_GROUP)
        return change_table(
            spark, path, stored.filter(F.col("url").isNotNull()),
            lambda state: tracking_upsert(state, stored, threshold, rule, touched_only=True), origin, batch, buckets)


def transition_table(spark: SparkSession, path: str, changes: DataFrame, **commit) -> DataFrame:
    return change_table(spark, path, changes, lambda state: status_transition(state, changes), **commit)


def refresh_table(spark: SparkSession, path: str, details: DataFrame, **commit) -> DataFrame:
    return change_table(spark, path, details, lambda state: detail_refresh(state, details), **commit)


def rollback_table(spark: SparkSession, path: str, urls: DataFrame, status: str, **commit) -> DataFrame:
    return change_table(spark, path, urls, lambda state: failed_write_rollback(state, urls, status), **commit)


def claim_table(spark: SparkSession, path: str, now: Column, limit: int | None = None, reclaim_failed: bool = False, **commit) -> DataFrame:
    """Claim URLs of the stored table: reads the rows still to be crawled, writes the claimed ones.

    Returns them as CHANGED. Same rows and order as :func:`~townvoice.operators.tracking.claim_pending`.
    """
    pending = read_table(spark, path, pending=True)
    if pending is None:
        return spark.createDataFrame([], TRACKING_SCHEMA)
    with scratch(f"{path}/scratch"):
        taken = materialize(claim_pending(pending, now, limit, reclaim_failed)[0], "claimed")
        stored = change_table(spark, path, taken, lambda state: state.withColumn("status", F.lit("UNCHANGED")), **commit)
    return stored.withColumn("status", F.lit("CHANGED"))
