"""The seen set as a table that is asked for single ids.

What one micro-batch adds is a *run*. Its ids are dealt by a hash into as many parts as their
number asks for (a power of two, at most `PARTS`), so that a small run is one file and not many
tiny ones: a folder of ids per part, and beside it a Bloom filter per part. A probe goes to the
filters of the parts its ids fall into, and then opens only those (run, part) folders whose filter
says that an id may be there; nothing else of the seen set is read, however large it has become.
The parts of a run of n are numbered n to 2n - 1, so a part's number tells how its run is dealt.

Runs are merged like the digits of a number: every `FAN`-th batch the last `FAN` runs of a level
become one of the next level. So there are fewer than `FAN` runs per level, and an id is
rewritten once per level. Which runs make up the set before a batch follows from the batch's
number alone, and a batch writes only folders of its own number: when it is run again
after a failure, it reads what it read before and overwrites what it wrote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PARTS = 64
FAN = 16
# Ids of one part, until a run has PARTS of them.
PART_IDS = 50_000
# Fixed value: bits of the bitmaps that the bitmap functions make.
BITS = 32_768
#: Ids of a bitmap, and bits set for each: under one in a hundred other ids passes.
BLOCK_IDS, HASHES = 3_000, 4

IDS = "id STRING, part INT"
FILTERS = "blocks BIGINT, block BIGINT, bitmap BINARY, part INT"


def part_count(ids: int) -> int:
    """Parts of a run with so many ids: the power of two that gives each about PART_IDS or fewer."""
    parts = 1
    while parts < PARTS and parts * PART_IDS < ids:
        parts *= 2
    return parts


def _dealing(part: int) -> int:
    """How many parts the run of a part has: the highest power of two in its number."""
    return 1 << (part.bit_length() - 1)


def _part(parts: Column | int) -> Column:
    parts = F.lit(parts) if isinstance(parts, int) else parts
    return (parts + F.pmod(F.xxhash64("id"), parts)).cast("int")


def _block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(-1)), F.col(blocks))


def _bit(k: int):
    return F.pmod(F.xxhash64("id", F.lit(k)), F.lit(BITS))


def bloom_filters(ids: DataFrame, blocks: int) -> DataFrame:
    """part, blocks, block and bitmap of ids (id, part), with so many bitmaps per part."""
    dealt = ids.withColumn("blocks", F.lit(blocks).cast("bigint")).withColumn("block", _block("blocks"))
    bits = dealt.select("part", "blocks", "block", F.explode(F.array(*[_bit(k) for k in range(HASHES)])).alias("bit"))
    return bits.groupBy("part", "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def _is_set(k: int):
    """Whether the k-th bit of an id is set in `bitmap`."""
    byte = F.expr(f"cast(conv(hex(substring(bitmap, cast(shiftright(_bit{k}, 3) AS INT) + 1, 1)), 16, 10) AS INT)")
    return byte.bitwiseAND(F.expr(f"shiftleft(1, cast(_bit{k} & 7 AS INT))")) != 0


class SeenTable:
    """Seen ids under `path`, by the batch that added them; batches are numbered without gaps."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def runs(self, batch_id: int) -> list[tuple[int, int]]:
        """(level, first batch) of the runs that hold what was added before a batch."""
        out, start, width = [], 0, 1
        while width * FAN <= batch_id:
            width *= FAN
        while width:
            while start + width <= batch_id:
                out.append((width, start))
                start += width
            width //= FAN
        return out

    def _folder(self, kind: str, run: tuple[int, int]) -> str:
        return f"{self.path}/{kind}/level={run[0]}/start={run[1]}"

    def _parts(self, run: tuple[int, int]) -> set[int]:
        """The parts that a run has ids of; a run may have none."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder("ids", run))
        files = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []
        return {int(n.removeprefix("part=")) for n in names if n.startswith("part=")}

    def _read(self, kind: str, schema: str, places: list[tuple[tuple[int, int], int]]) -> DataFrame:
        """Rows of (run, part) folders, with the run's level and start."""
        if not places:
            return self.spark.createDataFrame([], f"{schema}, level INT, start INT")
        full = f"{schema}, level INT, start INT"
        folders = [f"{self._folder(kind, run)}/part={part}" for run, part in places]
        return self.spark.read.schema(full).option("basePath", f"{self.path}/{kind}").parquet(*folders)

    def _write(self, ids: DataFrame, run: tuple[int, int], number: int) -> None:
        """Write a run of `number` ids (id)."""
        parts = part_count(number)
        even = (lambda rows: rows.coalesce(1)) if parts == 1 else (lambda rows: rows.repartition(parts, "part"))
        sorted_ids = even(ids.select("id", _part(parts).alias("part"))).sortWithinPartitions("part", "id")
        folder = self._folder("ids", run)
        sorted_ids.write.mode("overwrite").partitionBy("part").parquet(folder)
        written = self._read("ids", IDS, [(run, p) for p in sorted(self._parts(run))])
        # Parts are even, as a hash deals them.
        filters = even(bloom_filters(written.select("id", "part"), max(1, -(-number // (parts * BLOCK_IDS)))))
        filters.write.mode("overwrite").partitionBy("part").parquet(self._folder("filters", run))

    def candidates(self, ids: DataFrame, batch_id: int) -> list[tuple[tuple[int, int], int]]:
        """(run, part) folders that may hold one of `ids` (id); at most a few per part and level."""
        held = {run: self._parts(run) for run in self.runs(batch_id)}
        dealings = sorted({_dealing(p) for parts in held.values() for p in parts})
        if not dealings:
            return []
        # Parts of a finer dealing tell those of a coarser one, as both are powers of two.
        finest = dealings[-1]
        asked = {r.part - finest for r in ids.select(_part(finest).alias("part")).distinct().collect()}
        wanted = {n + k % n for n in dealings for k in asked}
        places = [(run, p) for run, parts in held.items() for p in sorted(parts & wanted)]
        if not places:
            return []
        filters = self._read("filters", FILTERS, places)
        # One row per folder: which block of its filter an id belongs to.
        dealt = ids.select("id", F.explode(F.array(*[_part(n) for n in dealings])).alias("part"))
        size = F.broadcast(filters.select("level", "start", "part", "blocks").distinct())
        bits = {f"_bit{k}": _bit(k) for k in range(HASHES)}
        met = dealt.join(size, "part").withColumn("block", _block("blocks")).withColumns(bits).drop("blocks")
        met = met.join(filters.drop("blocks"), ["level", "start", "part", "block"])
        for k in range(HASHES):
            met = met.where(_is_set(k))
        found = met.select("level", "start", "part").distinct().collect()
        return sorted(((r.level, r.start), r.part) for r in found)

    def hits(self, ids: DataFrame, batch_id: int) -> DataFrame:
        """The ids (id) that batches before this one added."""
        places = self.candidates(ids, batch_id)
        held = self._read("ids", IDS, places).select("id")
        return ids.select("id").join(held, "id", "left_semi")

    def add(self, ids: DataFrame, batch_id: int) -> None:
        """Add a batch's new ids (id; distinct, and none of them held before)."""
        number = ids.count()
        self._write(ids, (1, batch_id), number)
        total = self.spark.range(1).select(F.lit(self.total(batch_id) + number).cast("bigint").alias("total"))
        total.coalesce(1).write.mode("overwrite").parquet(self._total(batch_id))
        width = FAN
        while (batch_id + 1) % width == 0:
            self._merge(width, batch_id + 1 - width)
            width *= FAN

    def _merge(self, width: int, start: int) -> None:
        """Make the runs of the level below one run."""
        below = [(width // FAN, start + i * width // FAN) for i in range(FAN)]
        ids = self._read("ids", IDS, [(run, p) for run in below for p in sorted(self._parts(run))])
        self._write(ids, (width, start), ids.count())

    def _total(self, batch_id: int) -> str:
        return f"{self.path}/totals/batch={batch_id}"

    def total(self, batch_id: int) -> int:
        """A1: how many ids batches before this one added; reads one row."""
        if batch_id == 0:
            return 0
        return self.spark.read.schema("total BIGINT").parquet(self._total(batch_id - 1)).head().total
