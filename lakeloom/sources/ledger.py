"""The keys a growing table holds, as hash-bucketed runs with levels.

Every batch of keys is one sorted run, cut into buckets by the leading bits of
the keys' hash, with a Bloom filter per bucket. A new batch reads the filters
of the buckets that its keys fall into, and of the runs only the buckets in
which a filter leaves a key open. When a level has ``FAN`` runs they are merged
into one of the next level, so a key is written once per level, and a batch
meets a number of runs that grows with the logarithm of the number of batches.
The state, a list of runs, is an immutable version that one rename publishes.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import delete_path, materialise
from lakeloom.sources import versions

#: Runs of a level that are merged, keys that a bucket holds about, and the most bits of the hash that number buckets.
FAN, BUCKET_KEYS, MOST_BITS = 8, 200_000, 12
#: Bits and probes of a Bloom filter per key: about one key in 300 is left open by mistake.
FILTER_BITS, PROBES = 12, 4
#: Keys up to which a run is read without asking a filter.
UNFILTERED = 10_000
#: Keys asked for per bucket beyond which a filter is not asked either: by mistake alone it would leave nearly every bucket open.
ASKED_PER_BUCKET = 1_500


@dataclass
class Run:
    """One sorted run: its folder name, level, keys, bits of the bucket number and bits of each filter (0: a small run without)."""

    name: str
    level: int
    rows: int
    bits: int
    filter_bits: int
    token: str | None = None


@dataclass
class State:
    """What a version of the ledger says: its runs, and the batch numbers they cover, as ranges."""

    runs: list[Run] = field(default_factory=list)
    noted: list[list[int]] = field(default_factory=list)

    def covers(self, number: int) -> bool:
        return any(a <= number <= b for a, b in self.noted)

    def add(self, number: int) -> None:
        """Mark one more batch number as covered."""
        ranges = sorted([*self.noted, [number, number]])
        joined = [ranges[0][:]]
        for a, b in ranges[1:]:
            if a <= joined[-1][1] + 1:
                joined[-1][1] = max(joined[-1][1], b)
            else:
                joined.append([a, b])
        self.noted = joined


def _bucket(h: Column | str, bits: int) -> Column:
    """Leading ``bits`` of a 64-bit hash."""
    return F.shiftrightunsigned(h, 64 - bits).cast("int") if bits else F.lit(0)


def _spots(h: str, filter_bits: int) -> list[Column]:
    """Places of a key in its filter."""
    return [F.xxhash64(F.col(h), F.lit(i)).bitwiseAND(F.lit(filter_bits - 1)) for i in range(PROBES)]


def _crowded(run: Run, asked_keys: int) -> bool:
    """Whether so many keys are asked for that a run is read whole instead of by its filters."""
    return not run.filter_bits or asked_keys >> run.bits > ASKED_PER_BUCKET


class KeyLedger:
    """Keys under ``path``: columns ``keys`` (text, hashed) and ``extra`` (text, kept beside them).

    ``numbers`` compares keys as whole numbers where they are some. NULL keys
    are never noted and never known.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], extra: list[str] | None = None, numbers: bool = False):
        self.spark, self.path, self.keys, self.extra, self.numbers = spark, path, list(keys), list(extra or []), numbers

    def _text(self, name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(text.try_cast("bigint").cast("string"), text) if self.numbers else text

    def hashed(self, df: DataFrame) -> DataFrame:
        """(h, *keys, *extra) of the rows of ``df`` whose keys are not NULL; extra columns it lacks are NULL."""
        extra = [F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in self.extra]
        named = df.select(*[self._text(c).alias(c) for c in self.keys], *extra).dropna(subset=self.keys)
        return named.select(F.xxhash64(*self.keys).alias("h"), *self.keys, *self.extra)

    def state(self) -> State:
        version = versions.current(self.spark, self.path)
        if version is None:
            return State()
        return State([Run(**r) for r in version.note["runs"]], version.note["noted"])

    def _publish(self, state: State) -> None:
        before = {r.name for v in versions.versions(self.spark, self.path) for r in (Run(**x) for x in v.note["runs"])}
        versions.publish_note(self.spark, self.path, {"runs": [vars(r) for r in state.runs], "noted": state.noted})
        after = {r["name"] for v in versions.versions(self.spark, self.path) for r in v.note["runs"]}
        # Runs that no version names any more; versions that readers may have open still name theirs.
        for name in before - after:
            delete_path(self.spark, f"{self.path}/runs/{name}")

    def _write(self, hashed: DataFrame, level: int, token: str | None) -> Run:
        """Store one run and its filters."""
        seen = Observation("rows")
        stored = materialise(hashed.distinct().observe(seen, F.count("*").alias("rows")), "run-keys")
        rows = seen.get["rows"]
        bits = min(MOST_BITS, max(0, (rows // BUCKET_KEYS).bit_length()))
        per_bucket = max(1, rows >> bits)
        filter_bits = 1 << max(6, (FILTER_BITS * per_bucket - 1).bit_length()) if rows > UNFILTERED else 0
        run = Run(f"{level}-{uuid.uuid4().hex}", level, rows, bits, filter_bits, token)
        folder = f"{self.path}/runs/{run.name}"
        dealt = stored.withColumn("bucket", _bucket("h", bits))
        dealt = dealt.repartition(1 << bits, "bucket") if bits else dealt.coalesce(1)
        dealt.sortWithinPartitions("bucket", "h").write.partitionBy("bucket").parquet(f"{folder}/keys")
        if not filter_bits:
            return run
        spots = stored.select(_bucket("h", bits).alias("bucket"), F.explode(F.array(*_spots("h", filter_bits))).alias("spot"))
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("spot").bitwiseAND(F.lit(63)).cast("int"))
        words = spots.groupBy("bucket", F.shiftright("spot", 6).alias("word")).agg(F.bit_or(one).alias("bits"))
        filters = words.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w"))
        filters = filters.select("bucket", F.col("w.word").alias("words"), F.col("w.bits").alias("bits"))
        filters.repartitionByRange(max(1, (1 << bits) // 64), "bucket").sortWithinPartitions("bucket").write.parquet(f"{folder}/filters")
        return run

    def append(self, df: DataFrame, token: str | None = None, numbers: int | list[int] = ()) -> None:
        """Note the keys of ``df`` as one more run; the same ``token`` again replaces its run. ``numbers`` marks batches as covered."""
        run = self._write(self.hashed(df), 0, token)
        state = self.state()
        state.runs = [r for r in state.runs if token is None or r.token != token] + [run]
        for number in [numbers] if isinstance(numbers, int) else numbers:
            state.add(number)
        self._publish(self._merged(state))

    def _merged(self, state: State) -> State:
        """Merge full levels. The newest run stays by itself: its batch may be replayed."""
        *old, newest = state.runs
        level = 0
        while sum(r.level == level for r in old) >= FAN:
            full = [r for r in old if r.level == level]
            rows = reduce(lambda a, b: a.unionByName(b), (self._keys(r) for r in full))
            old = [r for r in old if r.level != level] + [self._write(rows, level + 1, None)]
            level += 1
        return State([*old, newest], state.noted)

    def _keys(self, run: Run, buckets: list[int] | None = None) -> DataFrame:
        names = ["h", *self.keys, *self.extra]
        read = self.spark.read.schema(", ".join(["h bigint", *(f"`{c}` string" for c in names[1:]), "bucket int"])).parquet(
            f"{self.path}/runs/{run.name}/keys")
        if buckets is not None:
            read = read.where(F.col("bucket").isin(buckets))
        return read.select(*names)

    def all(self, without: str | None = None) -> DataFrame | None:
        """(*keys, *extra) of the whole ledger, apart from the run with the token ``without``."""
        parts = [self._keys(r).drop("h") for r in self.state().runs if without is None or r.token != without]
        return reduce(lambda a, b: a.unionByName(b), parts) if parts else None

    def open_buckets(self, hashed: DataFrame, runs: list[Run]) -> list[tuple[Run, list[int]]]:
        """For each run the buckets in which its filters leave one of the keys open; at most 4,096 a run."""
        asked_keys = hashed.count()
        crowded = [r for r in runs if _crowded(r, asked_keys)]
        small = [(r, list(range(1 << r.bits))) for r in crowded]
        runs = [r for r in runs if r not in crowded]
        if not runs:
            return small
        lead = [r[0] for r in hashed.select(_bucket("h", MOST_BITS)).distinct().collect()]
        found = []
        for n, run in enumerate(runs):
            wanted = sorted({p >> (MOST_BITS - run.bits) for p in lead})
            filters = (self.spark.read.schema("bucket int, words array<bigint>, bits array<bigint>")
                       .parquet(f"{self.path}/runs/{run.name}/filters").where(F.col("bucket").isin(wanted)))
            words = filters.select("bucket", F.explode(F.arrays_zip("words", "bits")).alias("w")).select("bucket", "w.words", "w.bits")
            probes = (hashed.select("h", _bucket("h", run.bits).alias("bucket"), F.explode(F.array(*_spots("h", run.filter_bits))).alias("spot"))
                      .withColumn("words", F.shiftright("spot", 6)))
            bit = F.call_function("shiftright", F.col("bits"), F.col("spot").bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
            hits = (probes.join(words, ["bucket", "words"]).where(bit).groupBy("h", "bucket")
                    .agg(F.count_distinct("spot").alias("hits")))
            asked = hashed.select("h", F.size(F.array_distinct(F.array(*_spots("h", run.filter_bits)))).alias("asked"))
            found.append(hits.join(asked, "h").where("hits = asked").select(F.lit(n).alias("run"), "bucket").distinct())
        left: dict[int, list[int]] = {}
        for r in reduce(lambda a, b: a.unionByName(b), found).collect():
            left.setdefault(r["run"], []).append(r["bucket"])
        return small + [(runs[n], sorted(buckets)) for n, buckets in sorted(left.items())]

    def known(self, df: DataFrame, without: str | None = None) -> DataFrame:
        """(*keys, *extra) of the ledger's entries with the keys of ``df``, apart from the run with the token ``without``."""
        return self._found(self.hashed(df), self._runs(without))

    def _runs(self, without: str | None) -> list[Run]:
        return [r for r in self.state().runs if without is None or r.token != without]

    def _found(self, asked: DataFrame, runs: list[Run]) -> DataFrame:
        """(*keys, *extra) of the entries of ``runs`` with the keys of ``asked``, which has h and the keys."""
        hashed = materialise(asked.select("h", *self.keys).distinct(), "asked-keys")
        # Only these buckets are read.
        parts = [self._keys(run, buckets) for run, buckets in self.open_buckets(hashed, runs)]
        if not parts:
            return hashed.select(*self.keys, *[F.lit(None).cast("string").alias(c) for c in self.extra]).limit(0)
        entries = reduce(lambda a, b: a.unionByName(b), parts)
        return entries.join(hashed, ["h", *self.keys], "left_semi").select(*self.keys, *self.extra).distinct()

    def exclude(self, df: DataFrame, by: list[str] | None = None, without: str | None = None,
                asked: DataFrame | None = None) -> DataFrame:
        """The rows of ``df`` whose ``by`` (keys, and perhaps extra columns) the ledger does not hold.

        An extra column that is not noted for a key counts as any value.
        Where ``df`` is dealt by its keys already, ``asked`` is a stored table
        with the same keys: runs that they crowd are then compared with ``df``
        as they are, and only of the others are the entries looked up first.
        """
        by = list(by or self.keys)
        runs = self._runs(without)
        if not runs:
            return df
        hashed, crowded = self.hashed(df if asked is None else asked), []
        if asked is not None:
            # An estimate will do: it chooses the way, not the rows.
            number = hashed.agg(F.approx_count_distinct("h")).first()[0]
            crowded = [r for r in runs if _crowded(r, number)]
        parts = [self._keys(r).drop("h") for r in crowded]
        others = [r for r in runs if r not in crowded]
        if others:
            parts.append(self._found(hashed, others))
        entries = reduce(lambda a, b: a.unionByName(b), parts)
        known = entries.select(*[F.col(c).alias(f"_known_{c}") for c in [*self.keys, *self.extra]])
        same = [self._text(c) == F.col(f"_known_{c}") for c in self.keys]
        same += [F.col(f"_known_{c}").isNull() | (F.col(c).cast("string") == F.col(f"_known_{c}")) for c in by if c in self.extra]
        return df.join(known, reduce(lambda a, b: a & b, same), "left_anti")
