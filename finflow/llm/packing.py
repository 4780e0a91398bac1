"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

A document is its token ids and a final 0. Longer ones are cut into full sequences and a rest; the
open pieces (everything shorter than a sequence) are packed:

* Pieces are dealt into blocks of about ``BLOCK`` by hash. Every block evolves on ``ISLANDS``
  islands; an individual is a whole packing (bin of every piece). Crossover injects the
  well-filled bins of one parent into the other, removes the bins that now hold duplicates and
  puts the displaced pieces back by best fit, longest first. After each epoch every island sends its best
  individual to the next island of the ring. An island stops as soon as its packing reaches the
  lower bound.
* Bins that stay under-filled are opened again and packed together with those of other blocks,
  level by level, until one block is left or nothing is gained.

Defined cases: a null text counts as empty and is the single id 0; repeated rows are pieces of their own;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finflow.llm.common import written
from finflow.llm.tokens import encoder, slices, vocabulary

LENGTH = 2048
BLOCK = 4096
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 2, 2, 6, 4
#: Bins filled to less than this share are opened again at the next level.
TIGHT = 0.999
LEVELS = 8


def pieces_of(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """uid, doc_id, piece, start, length, ids_crc32 of every piece."""

    def run(batches):
        from pyspark import TaskContext
        coder, uid = encoder(path), TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            rows, row = [], 0
            for part in slices(texts):
                for ids in coder.many(part):
                    ids += b"\0\0\0\0"
                    for k, at in enumerate(range(0, len(ids), 4 * length)):
                        own = ids[at:at + 4 * length]
                        rows.append((uid, row, k, k * length, len(own) // 4, zlib.crc32(own)))
                        uid += 1
                    row += 1
            u, r, *rest = zip(*rows) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), batch.column(0).take(pa.array(r, pa.int64())), pa.array(rest[0], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in rest[1:]]],
                names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"uid long, doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Packer:
    """Packings of one block: arrays with the bin of every piece."""

    def __init__(self, sizes: np.ndarray, cap: int, seed: int):
        self.sizes, self.cap = sizes.astype(np.int64), cap
        self.rng = np.random.default_rng(seed)
        self.bound = int(-(-self.sizes.sum() // cap))

    def best_fit(self, bins: np.ndarray, todo: np.ndarray) -> np.ndarray:
        """Puts the pieces of ``todo`` (in that order) into the fullest bin that takes them."""
        bins, cap, sizes = bins.copy(), self.cap, self.sizes
        used = bins >= 0
        count = int(bins.max(initial=-1)) + 1
        room = cap - np.bincount(bins[used], sizes[used], count).astype(np.int64)
        free: dict[int, list[int]] = {}  # bins by room left; mask has a bit for each room that occurs
        mask = 0
        for b, r in enumerate(room.tolist()):
            if r > 0:
                free.setdefault(r, []).append(b)
                mask |= 1 << r
        for i in todo.tolist():
            n = int(sizes[i])
            above = mask >> n
            if above:
                r = n + ((above & -above).bit_length() - 1)
                b = free[r].pop()
                if not free[r]:
                    mask &= ~(1 << r)
            else:
                r, b = cap, count
                count += 1
            bins[i] = b
            if r > n:
                free.setdefault(r - n, []).append(b)
                mask |= 1 << (r - n)
        return bins

    def longest_first(self, todo: np.ndarray, jitter: float = 0.0) -> np.ndarray:
        keys = self.sizes[todo] * (1 + jitter * self.rng.standard_normal(len(todo))) if jitter else self.sizes[todo]
        return todo[np.argsort(-keys, kind="stable")]

    def new(self, jitter: float) -> np.ndarray:
        return self.best_fit(np.full(len(self.sizes), -1, np.int64), self.longest_first(np.arange(len(self.sizes)), jitter))

    def fitness(self, bins: np.ndarray) -> tuple[int, float]:
        """Fewer bins first; then the fuller ones fuller (mean squared fill)."""
        fill = np.bincount(bins, self.sizes) / self.cap
        return -len(fill), float((fill ** 2).mean())

    def cross(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Injects well-filled bins of ``b`` into ``a``."""
        fill = np.bincount(b, self.sizes) / self.cap
        chance = np.where(fill >= 1, 0.5, 0.35 * fill ** 8)
        taken = self.rng.random(len(fill)) < chance
        injected = taken[b]
        spoilt = np.zeros(int(a.max()) + 1, bool)
        spoilt[a[injected]] = True  # bins of a that would hold duplicates go as a whole
        # A few of the worst bins of a go as well, so that their pieces can move.
        worst = np.bincount(a, self.sizes) / self.cap < self.rng.uniform(0.9, 1.0)
        out = np.where(spoilt[a] | worst[a], -1, a)
        out = np.where(injected, len(spoilt) + b, out)
        names, packed = np.unique(out, return_inverse=True)
        out = packed - 1 if len(names) and names[0] == -1 else packed
        return self.best_fit(out, self.longest_first(np.flatnonzero(out < 0), 0.02))

    def done(self, bins: np.ndarray) -> bool:
        return int(bins.max()) + 1 <= self.bound

    def evolve(self, start: list[np.ndarray], island: int, generations: int) -> list[np.ndarray]:
        people = list(start) or [self.new(0.0 if not island else 0.05)]
        if any(map(self.done, people)):
            return sorted(people, key=self.fitness, reverse=True)[:1]
        while len(people) < POPULATION:
            people.append(self.new(0.1))
        for _ in range(generations):
            people.sort(key=self.fitness, reverse=True)
            i, j = sorted(self.rng.choice(len(people), 2, replace=False))
            child = self.cross(people[i], people[j]) if self.rng.random() < 0.5 else self.cross(people[j], people[i])
            if self.fitness(child) > self.fitness(people[-1]):
                people[-1] = child
            if self.done(child):
                break
        return sorted(people, key=self.fitness, reverse=True)


def _epoch(islands: DataFrame, cap: int, epoch: int) -> DataFrame:
    """Evolves every row (block, island, sizes, people) by some generations."""

    def run(batches):
        for batch in batches:
            for row in batch.select(["block", "island", "uids", "sizes", "people"]).to_pylist():
                packer = Packer(np.array(row["sizes"]), cap, zlib.crc32(f"{row['block']}:{row['island']}:{epoch}".encode()))
                people = packer.evolve([np.array(p, np.int64) for p in row["people"]], row["island"], GENERATIONS)
                row["people"] = [p.astype(np.int32).tolist() for p in people]
                row["bins"], row["fill"] = (lambda f: (-f[0], f[1]))(packer.fitness(people[0]))
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("uids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
                        ("people", pa.list_(pa.list_(pa.int32()))), ("bins", pa.int32()), ("fill", pa.float64())])
    return islands.mapInArrow(run, "block long, island int, uids array<bigint>, sizes array<int>, people array<array<int>>, bins int, fill double")


def _level(pieces: DataFrame, blocks: int, cap: int, name: str) -> DataFrame:
    """uid, length, block, bin of every piece (uid, length) from the best island of its block."""
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
    # A block is a hash class of about BLOCK pieces, one row from here on.
    rows = dealt.groupBy("block").agg(F.array_sort(F.collect_list(F.struct(F.col("length").cast("int").alias("size"), "uid"))).alias("p"))
    state = rows.select("block", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"),
                        F.col("p.uid").alias("uids"), F.col("p.size").alias("sizes"),
                        F.array().cast("array<array<int>>").alias("people"))
    for epoch in range(EPOCHS):
        # A row is a whole island; spread them, whatever Spark makes of their few bytes.
        state = written(_epoch(state.repartition(F.col("block"), F.col("island")), cap, epoch), f"{name}-islands")
        if epoch + 1 < EPOCHS:
            elite = state.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.get("people", 0).alias("guest"))
            # The guest takes the place of the weakest.
            state = state.join(elite, ["block", "island"]).withColumn(
                "people", F.concat(F.array("guest"), F.slice("people", 1, POPULATION - 1))).drop("guest", "bins", "fill")
    best = state.groupBy("block").agg(F.max_by(F.struct("uids", "sizes", F.get("people", 0).alias("bins")),
                                               F.struct(-F.col("bins"), "fill", -F.col("island"))).alias("b"))
    flat = F.explode(F.arrays_zip("b.uids", "b.sizes", "b.bins"))
    return best.select("block", flat.alias("x")).select(
        F.col("x.uids").alias("uid"), F.col("x.sizes").cast("long").alias("length"), "block", F.col("x.bins").alias("bin"))


def packed(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``.

    A sequence is named by the smallest uid of its pieces, which also come in uid order.
    """
    pieces = written(pieces_of(docs, path or vocabulary(), length), "pieces")
    full = pieces.where(F.col("length") == length).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    todo, done = pieces.where(F.col("length") < length).select("uid", "length"), []
    todo_rows = todo.count()
    for level in range(LEVELS):
        if not todo_rows:
            break
        blocks = -(-todo_rows // BLOCK)
        bins = written(_level(todo, blocks, length, f"level-{level}"), "bins")
        if blocks == 1:
            done.append(bins)
            todo_rows = 0
            break
        fill = bins.groupBy("block", "bin").agg(F.sum("length").alias("fill"))
        loose = fill.where(F.col("fill") < TIGHT * length).select("block", "bin")
        rest = written(bins.join(loose, ["block", "bin"], "left_semi").select("uid", "length"), "loose")
        rest_rows = rest.count()
        if rest_rows > todo_rows * 0.7 or level == LEVELS - 1:  # opening them again gains little
            done.append(bins)
            todo_rows = 0
            break
        done.append(bins.join(loose, ["block", "bin"], "left_anti").select("uid", "length", "block", "bin"))
        todo, todo_rows = rest, rest_rows
    for level, bins in enumerate(done):
        own = bins.groupBy("block", "bin").agg(F.array_sort(F.collect_list(F.struct("uid", "length"))).alias("p"))
        # A bin holds at most ``length`` pieces: every piece has a token.
        sums = F.aggregate(F.slice("p", 1, F.size("p") - 1), F.array(F.lit(0).cast("long")),
                           lambda acc, x: F.concat(acc, F.array(F.get(acc, F.size(acc) - 1) + x["length"])))
        own = own.select(F.explode(F.arrays_zip(F.col("p.uid").alias("uid"), sums.alias("offset"))).alias("x"), F.get("p.uid", 0).alias("sequence_id"))
        full = full.unionByName(own.select(F.col("x.uid").alias("uid"), "sequence_id", F.col("x.offset").alias("offset")))
    return pieces.join(full, "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
