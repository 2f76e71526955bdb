"""A digest table that grows by numbered versions.

``records/v=n``      parsed records of load ``n``, valid and rejected ones apart
``delta/v=n``        digests of load ``n`` alone
``occurrences/v=n``  distinct times of load ``n``
``base/v=n``         merge of all loads up to ``n``
``batches/v=n``      one BATCH row for load ``n``; ``failures`` has one per failed try
``rejects/v=n``      rejected blocks of load ``n`` per reason
``expiring``, ``expired``  what each retention run removes, and what it has removed

A load writes in proportion to its own input.  Readers merge the latest base with
the deltas after it; ``compact`` moves the base on.  Repeating a load overwrites
its own version, so nothing is ever counted twice.

Records and occurrences of several loads are folded into one folder (``r=a-b-g``, see
``storage``) in tiers of ``FAN``: eight loads become one run, eight such runs the next.
Every row is rewritten once a tier, and the number of folders grows with the logarithm
of the number of loads.  Retention rewrites only runs that hold something to remove.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slowdigest.operators.digest import (
    KEYS,
    check_order,
    digest,
    digest_documents,
    expired_digest,
    first_arrivals,
    merge_digests,
    occurrences,
    retention_cutoff,
)
from slowdigest.operators.validate import REASONS
from slowdigest.schema import BATCH_SCHEMA, DIGEST_SCHEMA, OCCURRENCE_SCHEMA, PARSED_SCHEMA
from slowdigest.sources.storage import (
    Run,
    committed_runs,
    committed_versions,
    cover,
    create_once,
    drop_run,
    exists,
    observed,
    stored_bytes,
    version_path,
)

#: Stored bytes from which a rollup takes two passes; below, a second pass costs more than it saves.
TWO_PASS_BYTES = 256 << 20
#: Runs of one tier that are folded into one of the next.
FAN = 8
RECORD_SCHEMA = T.StructType(
    PARSED_SCHEMA.fields
    + [
        T.StructField("reject_reason", T.StringType()),
        T.StructField("query_hash", T.StringType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)
_VERSION = T.StructField("v", T.LongType())
_REJECTS = T.StructType(
    [T.StructField("reject_reason", T.StringType()), T.StructField("blocks", T.LongType())]
)
_GONE = "query_hash string, instance_id string, up_to long, cutoff timestamp"
_COUNTS = "digests long, occurrences long, records long"


@dataclass(frozen=True)
class Expired:
    """Rows that a retention run has removed."""

    digests: int
    occurrences: int
    records: int


class DigestTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        order: str = "time",
        two_pass_bytes: int = TWO_PASS_BYTES,
    ):
        check_order(order)
        self.spark = spark
        self.root = root.rstrip("/")
        self.order = order
        self.two_pass_bytes = two_pass_bytes

    def _passes(self, part: str, runs: list[Run]) -> int:
        return 2 if stored_bytes(self.spark, self._folder(part), runs) >= self.two_pass_bytes else 1

    def _folder(self, part: str) -> str:
        return f"{self.root}/{part}"

    def claim(self, writer: str) -> None:
        """Let one writer number the loads; a second one would overwrite them and is refused.

        Of two that come at once, the file system lets one name the folder.
        """
        folder = self._folder("writer")

        def note(path: str) -> None:
            self.spark.createDataFrame([(writer,)], "writer string").coalesce(1).write.parquet(path)

        def known() -> str | None:
            files = f"{folder}/part-*"
            if not exists(self.spark, files):
                return None
            return self.spark.read.schema("writer string").parquet(files).first()["writer"]

        owner = known()
        if owner is None:
            create_once(self.spark, folder, note)
            owner = known()
        if owner != writer:
            raise RuntimeError(f"{self.root} is written by {owner}, not by {writer}")

    def versions(self) -> list[int]:
        """Loads that are complete: the delta is the last thing a load writes."""
        return committed_versions(self.spark, self._folder("delta"))

    def _read(self, part: str, schema: T.StructType, runs: list[Run]) -> DataFrame:
        """Rows of the given folders, with ``v``: from the folder's name, or stored where loads are folded."""
        folder = self._folder(part)
        whole = T.StructType([*schema.fields, _VERSION])

        def read(base: str, *paths: str) -> DataFrame:
            rows = self.spark.read.schema(whole).option("basePath", base).parquet(*paths)
            return rows.select(*whole.names)

        single = [f"{folder}/{r.name}" for r in runs if r.name.startswith("v=")]
        # Records are kept apart by ``rejected`` below the folder of their run.
        found = [read(path, path) for path in (f"{folder}/{r.name}" for r in runs) if path not in single]
        if single:
            found.append(read(folder, *single))
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], whole)

    def write(self, version: int, records: DataFrame, *, index_prefix: str) -> dict[str, int]:
        """Store load ``version``; ``records`` has the columns of ``RECORD_SCHEMA``.

        Returns how many are ``valid``, and how many rejected by each reason: counted while the
        records are written, so nothing is read back for it.
        """
        stored = version_path(self._folder("records"), version)
        seen = Observation()
        reason = F.col("reject_reason")
        counted = records.select(*RECORD_SCHEMA.names).observe(
            seen,
            F.count_if(reason.isNull()).alias("valid"),
            *(F.count_if(reason == r).alias(r) for r in REASONS),
        )
        counted.write.mode("overwrite").partitionBy("rejected").parquet(stored)
        counts = observed(seen)
        # Both rollups read the written records: parsing and hashing happen once,
        # and a lost executor does not send them back to the log text.
        valid = self.spark.read.schema(RECORD_SCHEMA).parquet(stored).filter(~F.col("rejected"))
        occurrences(valid).write.mode("overwrite").parquet(
            version_path(self._folder("occurrences"), version)
        )
        passes = self._passes("records", [Run(version, version, 0)])
        digest(valid, index_prefix=index_prefix, order=self.order, passes=passes).write.mode(
            "overwrite"
        ).parquet(version_path(self._folder("delta"), version))
        return {name: counts.get(name, 0) for name in ("valid", *REASONS)}

    def load(
        self, version: int, records: DataFrame, *, index_prefix: str, job: str = "slow-log"
    ) -> None:
        """``write``, with a BATCH row and its rejects: a BATCH row for a failed try too, before it is raised."""
        started = time.monotonic()

        def note(size: int, error: str | None) -> DataFrame:
            row = (job, version, size, time.monotonic() - started, error is None, error)
            return self.spark.createDataFrame([row], BATCH_SCHEMA).coalesce(1)

        try:
            counts = self.write(version, records, index_prefix=index_prefix)
        except Exception as e:
            note(0, type(e).__name__).write.mode("append").parquet(self._folder("failures"))
            raise
        refused = [(r, counts[r]) for r in REASONS if counts[r]]
        self.spark.createDataFrame(refused, _REJECTS).coalesce(1).write.mode("overwrite").parquet(
            version_path(self._folder("rejects"), version)
        )
        note(counts["valid"], None).write.mode("overwrite").parquet(
            version_path(self._folder("batches"), version)
        )

    def rejects(self) -> DataFrame:
        """Rejected blocks per reason over all loads that ``load`` made; no record is read for it."""
        folder = self._folder("rejects")
        rows = self._read("rejects", _REJECTS, committed_runs(self.spark, folder))
        return rows.groupBy("reject_reason").agg(F.sum("blocks").alias("blocks"))

    def batches(self) -> DataFrame:
        """BATCH rows of all loads, failed tries included."""
        folder = self._folder("batches")
        done = self._read("batches", BATCH_SCHEMA, committed_runs(self.spark, folder))
        if not exists(self.spark, self._folder("failures")):
            return done.drop("v")
        failed = self.spark.read.schema(BATCH_SCHEMA).parquet(self._folder("failures"))
        return done.drop("v").unionByName(failed)

    def _merged(self, up_to: int | None, base_up_to: int | None) -> DataFrame:
        """The latest base of ``base_up_to`` at most, merged with the deltas after it up to ``up_to``."""
        within = lambda v, most: most is None or v <= most
        bases = [r for r in committed_runs(self.spark, self._folder("base")) if within(r.last, base_up_to)]
        base = sorted(bases, key=lambda r: (r.last, r.generation))[-1:]
        start = base[0].last if base else -1
        after = [v for v in self.versions() if v > start and within(v, up_to)]
        if after and after != list(range(start + 1, after[-1] + 1)):
            raise RuntimeError(f"{self.root}: loads after version {start} are incomplete: {after}")
        deltas = [Run(v, v, 0) for v in after]
        old = self._read("base", DIGEST_SCHEMA, base).withColumn("v", F.lit(start).cast("bigint"))
        both = old.unionByName(self._read("delta", DIGEST_SCHEMA, deltas))
        passes = max(self._passes("base", base), self._passes("delta", deltas))
        return merge_digests(both, generation="v", order=self.order, passes=passes)

    def digests(self, up_to: int | None = None) -> DataFrame:
        """Merged digests of all complete loads, or of those up to a version."""
        return self._merged(up_to, up_to)

    def occurrences(self) -> DataFrame:
        """Distinct occurrence times over all complete loads."""
        return occurrences(self._read("occurrences", OCCURRENCE_SCHEMA, self.runs("occurrences")))

    def newest(self) -> int:
        """The last complete load; -1 without any."""
        bases = committed_runs(self.spark, self._folder("base"))
        return max([*self.versions(), *(r.last for r in bases)], default=-1)

    def runs(self, part: str, up_to: int | None = None) -> list[Run]:
        """Folders that hold all complete loads of records or occurrences, each load once."""
        most = self.newest() if up_to is None else up_to
        return cover([r for r in committed_runs(self.spark, self._folder(part)) if r.last <= most])

    def versions_kept(self) -> list[int]:
        """All loads whose occurrence times are complete."""
        return [v for r in self.runs("occurrences") for v in range(r.first, r.last + 1)]

    def documents(self, *, page_size: int = 10_000) -> DataFrame:
        """Digests with their occurrence times, in pages (``digest_documents``)."""
        if self.order == "time":
            return digest_documents(self.digests(), self.occurrences(), page_size=page_size)
        # Earlier loads arrived earlier, whatever their files are called and when they changed.
        load = F.lpad(F.col("v").cast("string"), 12, "0")
        changed = F.coalesce(F.date_format("seq.modified", "yyyyMMddHHmmss.SSSSSS"), F.lit(""))
        file = F.concat_ws(":", load, changed, F.coalesce("seq.file", F.lit("")))
        valid = self.records().filter(~F.col("rejected"))
        placed = valid.withColumn(
            "seq", F.col("seq").withField("modified", F.lit(None).cast("timestamp")).withField("file", file)
        )
        return digest_documents(
            self.digests(), first_arrivals(placed), page_size=page_size, order="arrival"
        )

    def records(self) -> DataFrame:
        """Stored records, rejected ones included (``rejected``, ``reject_reason``)."""
        return self._read("records", RECORD_SCHEMA, self.runs("records"))

    def compact(self, version: int, *, keep: int = 2) -> None:
        """Write base ``version``, fold older loads, and drop what the last ``keep`` bases replace.

        A repeated call reads only older bases, so it writes the same base again.
        """
        base = self._folder("base")
        self._merged(version, version - 1).write.mode("overwrite").parquet(version_path(base, version))
        bases = committed_runs(self.spark, base)
        ends = sorted({r.last for r in bases})
        oldest = ends[-keep] if len(ends) >= keep else -1
        for r in bases:
            if r.last < oldest:
                drop_run(self.spark, base, r)
        for v in self.versions():
            if v <= oldest:
                drop_run(self.spark, self._folder("delta"), Run(v, v, 0))
        for part in ("occurrences", "records"):
            self.fold(part, version)

    def fold(self, part: str, up_to: int) -> None:
        """Fold ``FAN`` neighbouring runs of one tier into one of the next, as often as possible.

        What an earlier call replaced is dropped first, so that readers of this one's input can finish.  A
        repeated or interrupted call writes the same runs again; a load that is repeated after it was folded
        writes its own folder, which the run still replaces.
        """
        folder = self._folder(part)
        schema = OCCURRENCE_SCHEMA if part == "occurrences" else RECORD_SCHEMA
        stored = committed_runs(self.spark, folder)
        kept = cover([r for r in stored if r.last <= up_to])
        for r in stored:
            if r.last <= up_to and r not in kept:
                drop_run(self.spark, folder, r)
        while True:
            group = _next_fold(kept)
            if not group:
                return
            run = Run(group[0].first, group[-1].last, 0)
            rows = self._read(part, schema, group)
            if part == "occurrences":
                # Files of one time range each: a range of times is read from few of them.
                times = occurrences(rows).withColumn("v", F.lit(run.last).cast("bigint"))
                out = times.repartitionByRange("ts").sortWithinPartitions("query_hash", "ts").write
            else:
                out = rows.write.partitionBy("rejected")
            out.mode("overwrite").parquet(f"{folder}/{run.name}")
            kept = cover([*kept, run])

    def expire(self, days: int = 30, *, as_of: datetime | Column) -> Expired:
        """Remove fingerprints last seen ``days`` before ``as_of`` or earlier, and all that is stored of them.

        Their digests go, their occurrence times and their valid records; rejected records go by their own
        time.  A fingerprint that comes back in a later load starts anew.  The keys to remove are stored first:
        a call after an interrupted one finishes that one's work instead of starting its own, and counts what it
        has removed itself.  Only one call at a time, and no load beside it.
        """
        cutoff = retention_cutoff(days, as_of)
        done = committed_versions(self.spark, self._folder("expired"))
        number = done[-1] + 1 if done else 0
        stored = version_path(self._folder("expiring"), number)
        if number not in committed_versions(self.spark, self._folder("expiring")):
            up_to = self.newest()
            gone = expired_digest(self.digests(up_to), days, as_of=as_of).select(*KEYS)
            # One row without a key states the bounds even where nothing goes.
            bounds = self.spark.range(1).select(*(F.lit(None).cast("string").alias(k) for k in KEYS))
            gone.withColumn("_", F.lit(True)).unionByName(bounds.withColumn("_", F.lit(False))).select(
                *KEYS,
                F.lit(up_to).cast("bigint").alias("up_to"),
                cutoff.alias("cutoff"),
                F.col("_").alias("goes"),
            ).write.mode("overwrite").parquet(stored)
        noted = self.spark.read.schema(_GONE + ", goes boolean").parquet(stored)
        bound = noted.filter("not goes").first()
        keys = noted.filter("goes").select(F.struct(*KEYS).alias("_key")).distinct()
        digests = keys.count()
        if digests:
            bases = committed_runs(self.spark, self._folder("base"))
            own = [r for r in bases if r.last == bound["up_to"]]
            written = Run(0, bound["up_to"], max((r.generation for r in own), default=0) + 1)
            # Bodies are not merged anew for what stays: the merge is, and the keys are taken out of it.
            merged = self.digests(bound["up_to"])
            left = merged.join(keys, F.struct(*(merged[k] for k in KEYS)) == F.col("_key"), "left_anti")
            left.write.mode("overwrite").parquet(f"{self._folder('base')}/{written.name}")
        counts = [
            self._expire_part(part, keys, bound["up_to"], bound["cutoff"]) for part in ("occurrences", "records")
        ]
        result = Expired(digests, *counts)
        note = self.spark.createDataFrame([(result.digests, result.occurrences, result.records)], _COUNTS)
        note.coalesce(1).write.mode("overwrite").parquet(version_path(self._folder("expired"), number))
        return result

    def _expire_part(self, part: str, keys: DataFrame, up_to: int, cutoff: datetime) -> int:
        """Rewrite the runs that hold rows to remove; the number of rows removed."""
        folder = self._folder(part)
        schema = OCCURRENCE_SCHEMA if part == "occurrences" else RECORD_SCHEMA
        runs = self.runs(part, up_to)
        if not runs:
            return 0

        def marked(some: list[Run]) -> DataFrame:
            rows = self._read(part, schema, some).withColumn("_at", F.struct(*KEYS))
            rows = rows.join(keys.withColumn("_gone", F.lit(True)), F.col("_at") == F.col("_key"), "left")
            goes = F.coalesce("_gone", F.lit(False))
            if part == "records":
                old = F.coalesce(F.col("ts") <= F.lit(cutoff), F.lit(False))
                goes = F.when(F.col("rejected"), old).otherwise(goes)
            return rows.withColumn("_goes", goes)

        removed = 0
        for run in runs:
            n = marked([run]).filter("_goes").count()
            if n:
                left = marked([run]).filter("not _goes").select(*schema.names, "v")
                writer = left.write.partitionBy("rejected") if part == "records" else left.write
                writer.mode("overwrite").parquet(f"{folder}/{run.next().name}")
            removed += n
        return removed


def _tier(run: Run) -> int:
    width, tier = run.last - run.first + 1, 0
    while width >= FAN:
        width, tier = width // FAN, tier + 1
    return tier


def _next_fold(runs: list[Run]) -> list[Run]:
    """The first ``FAN`` neighbours of one tier; none if no tier is full."""
    group: list[Run] = []
    for run in sorted(runs):
        if group and (run.first != group[-1].last + 1 or _tier(run) != _tier(group[-1])):
            group = []
        group.append(run)
        if len(group) == FAN:
            return group
    return []
