"""MinHash near-duplicates through an LSH forest.

A document's set holds its distinct word shingles (64-bit hashes; five words unless a caller says
otherwise). Documents with one set form a *class*; only classes are compared. Every class has a
signature of ``SIGNATURE`` min-hashes; every tree of the forest orders the classes by its own
stretch of the signature, and classes whose longest common prefix in some tree reaches the depth of
their region are candidates:

1. *Leader rounds.* In each region (tree, prefix of ``DEPTH`` values) every class meets the
   region's leader, which is one row per class and region however large the region is. Verified
   links are contracted to components; regions inside one component are done.
2. *Completion.* In regions that still hold several components, the classes outside the largest
   one meet every class with which they share a prefix in some tree, dealt out in bounded blocks.
   A region of more than ``CROWD`` classes goes deeper first: several further prefixes (a small
   forest of its own, so that recall holds) split it, again and again until its parts are
   smaller, lie in one component, or the levels are used up.

Every candidate is confirmed on the full sets. Nothing is capped or dropped, and components are
computed by hooking and pointer jumping on DataFrames.

Defined cases: a null or blank text has no set, links with nothing and is its own component; texts
with fewer words than a shingle are one shingle as a whole; repeated rows are copies of each other;
a null ``doc_id`` takes part and never is a component's id unless all ids in it are null; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finflow.llm.common import WordHashes, free_name, mix64, written

SIGNATURE = 128
DEPTH = 5
TREES = 25
#: Deeper splits: how many sub-trees, and how many further values each of them compares.
SUB_TREES, SUB_DEPTH, SUB_LEVELS = 16, 4, 4
#: A region with several components and more classes than this is split deeper first.
CROWD = 4096
#: Classes of a cluster that a task sees on each side.
BLOCK = 256
LEADER_ROUNDS = 2
#: Chance that a linked pair agrees in fewer values than the estimate's floor: under 1e-5.
FLOOR_SIGMAS = 4.5

_rng = np.random.default_rng(20240501)
_MULTIPLIERS = _rng.integers(1, 2**63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _rng.integers(0, 2**63, SIGNATURE, dtype=np.uint64)


def shingles_of(data: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles (A-Z lower-cased, words by ASCII space)."""
    words = data.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(n, size)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = mix64(out * np.uint64(0xA24BAED4963EE407) + h[k:n - width + 1 + k])
    return np.unique(out)


def signature_of(shingles: np.ndarray) -> np.ndarray:
    low = np.full(SIGNATURE, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        part = (shingles[None, at:at + 1024] ^ _MASKS[:, None]) * _MULTIPLIERS[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def class_of(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def text_key():
    """Tells rows of one id with different texts apart (null: as empty)."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def sign(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_key, class_id, n_shingles, signature of every row (class and signature null without words)."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            ids, counts, sigs = [], [], []
            for data in _texts(batch.column(1)):
                s = shingles_of(data or b"", shingle, hashes)
                counts.append(len(s))
                ids.append(class_of(s) if len(s) else None)
                sigs.append(signature_of(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(ids, pa.binary()), pa.array(counts, pa.int64()),
                 pa.array(sigs, pa.list_(pa.int32()))],
                names=["doc_id", "text_key", "class_id", "n_shingles", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", text_key().alias("text_key")).mapInArrow(
        run, f"doc_id {kind}, text_key long, class_id binary, n_shingles long, signature array<int>")


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """class_id and full set of the wanted classes (class_id, rep, rep_key), recomputed from their texts."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            ids, sets = [], []
            for data, want in zip(_texts(batch.column(0)), batch.column(1).to_pylist()):
                s = shingles_of(data or b"", shingle, hashes)
                if len(s) and class_of(s) == want:
                    ids.append(want)
                    sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["class_id", "shingles"])

    rows = docs.select("doc_id", "text", text_key().alias("text_key"))
    # An id may stand on any number of rows, so the text's key is part of the join; only copies of one row meet a class more than once.
    rows = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["rep"]) & (rows["text_key"] == wanted["rep_key"])).select("text", "class_id")
    return rows.mapInArrow(run, "class_id binary, shingles array<bigint>").dropDuplicates(["class_id"])


def _floor(percent: int) -> int:
    """Values in which a linked pair agrees but for a chance of about 1e-5."""
    share = percent / 100
    return int(max(0.0, share - FLOOR_SIGMAS * (share * (1 - share) / SIGNATURE) ** 0.5) * SIGNATURE)


def _verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity; sizes and signatures rule out most others first."""
    side = lambda x: classes.select(F.col("class_id").alias(x), F.col("n").alias(f"n{x}"), F.col("signature").alias(f"s{x}"))
    agree = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, v: s + v)
    near = (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
            .where(agree >= _floor(percent)).select("a", "b"))
    near = written(near, "near-pairs")
    full = (near.join(sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("xa")), "a")
            .join(sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("xb")), "b"))
    both = F.size(F.array_intersect("xa", "xb"))
    return full.where(100 * both >= percent * (F.size("xa") + F.size("xb") - both)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) of every node of the edges (a, b).

    Every round hooks each node to its smallest neighbour, flattens the trees by pointer jumping
    and contracts the edges to roots; at least half of the remaining roots go each round.
    """
    labels = None
    edges = written(edges.where(F.col("a") != F.col("b")), "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("root"))
        while True:
            up = written(up, "hooks")
            over = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            moved = up.join(over, "root").where(F.col("root") != F.col("next"))
            if moved.isEmpty():
                break
            up = up.join(over, "root").select("node", F.col("next").alias("root"))
        labels = up if labels is None else written(
            labels.join(up.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
            .select("node", F.coalesce("to", "root").alias("root")), "labels")
        to = lambda x: up.select(F.col("node").alias(x), F.col("root").alias(f"{x}r"))
        edges = written(edges.join(to("a"), "a").join(to("b"), "b").where(F.col("ar") != F.col("br"))
                        .select(F.least("ar", "br").alias("a"), F.greatest("ar", "br").alias("b")).distinct(), "edges")
    if labels is None:
        kind = edges.schema["a"].dataType
        return edges.select(F.col("a").cast(kind).alias("node"), F.col("b").cast(kind).alias("root"))
    return labels


def _tree_keys(signature, values: list[list[int]], base=None):
    """One 64-bit key for each tree: its number and its values (after the key of the region above)."""
    head = [] if base is None else [base]
    return F.array(*[F.xxhash64(*head, F.lit(t), *[signature[i] for i in own]) for t, own in enumerate(values)])


def _shared(rows: DataFrame) -> DataFrame:
    """Rows (key, class_id, ...) of keys that occur more than once, with the count."""
    counts = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(counts, "key")


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("root", F.col("class_id"))
    return (members.join(labels.select(F.col("node").alias("class_id"), F.col("root").alias("to")), "class_id", "left")
            .withColumn("root", F.coalesce("to", "class_id")).drop("to"))


def _mixed(members: DataFrame) -> DataFrame:
    """Members of regions that hold more than one component."""
    regions = (members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"))
               .where("lo != hi").select("key", "size"))
    return members.drop("size").join(regions, "key")


def _grid(members: DataFrame, busy: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links (a, b) between different components of the members (key, class_id, root).

    Regions that share classes are taken together, so that a pair meets once and not once a tree.
    In each such cluster all classes outside its largest component meet all its classes, dealt
    out in blocks: a task sees at most two blocks of about ``BLOCK`` classes of a cluster.
    """
    low = members.groupBy("key").agg(F.min("class_id").alias("b"))
    chains = components(members.join(low, "key").select(F.col("class_id").alias("a"), "b"))
    rows = (members.select("class_id", "root").distinct()
            .join(chains.select(F.col("node").alias("class_id"), F.col("root").alias("cluster")), "class_id"))
    rows = written(rows, "clusters")
    shares = rows.groupBy("cluster", "root").agg(F.count("*").alias("n"))
    plan = shares.groupBy("cluster").agg(F.max_by("root", F.struct("n", "root")).alias("bulk"), F.sum("n").alias("all"),
                                         F.max("n").alias("most"))
    plan = plan.select("cluster", "bulk", F.ceil(F.col("all") / BLOCK).cast("int").alias("nb"),
                       F.greatest(F.lit(1), F.ceil((F.col("all") - F.col("most")) / BLOCK)).cast("int").alias("no"))
    rows = rows.join(plan, "cluster")
    block = lambda n, salt: F.pmod(F.xxhash64("class_id", F.lit(salt)), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    whole = rows.select("cluster", "class_id", "root", block("nb", 1).alias("nb"), upto("no").alias("no"), F.lit(False).alias("odd"))
    odd = rows.where("root != bulk").select("cluster", "class_id", "root", upto("nb").alias("nb"), block("no", 2).alias("no"),
                                            F.lit(True).alias("odd"))
    dealt = written(whole.unionByName(odd), "blocks")
    tasks = dealt.count() // (4 * BLOCK) + 1
    full = (dealt.join(busy.select("class_id", "signature"), "class_id").join(sets, "class_id")
            .withColumn("task", F.pmod(F.xxhash64("cluster", "nb", "no"), F.lit(tasks))))
    floor = _floor(percent)

    def run(group: pa.Table) -> pa.Table:
        found = []
        columns = [group.column(c).to_pylist() for c in ("cluster", "nb", "no", "odd", "class_id", "root")]
        sig = group.column("signature").combine_chunks().flatten().to_numpy().reshape(-1, SIGNATURE)
        values = group.column("shingles").combine_chunks()
        at, flat = values.offsets.to_numpy(), values.values.to_numpy().view(np.uint64)
        cells: dict = {}
        for i, cell in enumerate(zip(*columns[:3])):
            cells.setdefault(cell, ([], []))[columns[3][i]].append(i)
        for every, others in cells.values():
            up = {columns[5][i]: columns[5][i] for i in (*every, *others)}  # components joined in this cell

            def top(r, up=up):
                while up[r] != r:
                    r = up[r]
                return r

            for i in others:
                same = sig[every] == sig[i]
                agree = same.sum(axis=1)
                prefix = same[:, :TREES * DEPTH].reshape(len(every), TREES, DEPTH).all(axis=2).any(axis=1)
                for k in sorted(np.flatnonzero(prefix & (agree >= floor)), key=lambda k: -agree[k]):
                    j = every[k]
                    ri, rj = top(columns[5][i]), top(columns[5][j])
                    if ri == rj:
                        continue
                    x, y = flat[at[i]:at[i + 1]], flat[at[j]:at[j + 1]]
                    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                        continue
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        up[ri] = rj
                        found.append((columns[4][i], columns[4][j]))
        return pa.table({"a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([y for _, y in found], pa.binary())})

    return full.groupBy("task").applyInArrow(run, "a binary, b binary")


def _levels() -> list[list[list[int]]]:
    rng = np.random.default_rng(7)
    return [[sorted(rng.choice(SIGNATURE, SUB_DEPTH, replace=False).tolist()) for _ in range(SUB_TREES)]
            for _ in range(SUB_LEVELS)]


def link_classes(docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """node, root over the classes (class_id, rep, rep_key, n, signature) that link with another class."""
    # Sets of fewer shingles reach the similarity only with an equal set: s / (s + 1) is below it.
    smallest = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
    trees = [list(range(t * DEPTH, (t + 1) * DEPTH)) for t in range(TREES)]
    rows = (classes.where(F.col("n") >= smallest)
            .select("class_id", F.explode(_tree_keys(F.col("signature"), trees)).alias("key")))
    members = written(_shared(rows).select("key", "class_id"), "regions")
    busy = written(classes.join(members.select("class_id").distinct(), "class_id"), "candidates")
    sets = written(_sets(docs, busy.select("class_id", "rep", "rep_key"), shingle), "sets")
    edges, labels = None, None
    for turn in range(LEADER_ROUNDS):
        now = _mixed(_labelled(members, labels))
        # The leader is the member of the smallest hash, another one each round.
        order = F.struct(F.xxhash64("class_id", F.lit(turn)).alias("h"), F.col("class_id").alias("leader"))
        leaders = now.groupBy("key").agg(F.min(order).alias("o"))
        meet = (now.join(leaders.select("key", "o.h", "o.leader"), "key").where(F.col("leader") != F.col("class_id"))
                .groupBy("class_id").agg(F.min(F.struct("h", "leader")).alias("o"))
                .select(F.least("class_id", "o.leader").alias("a"), F.greatest("class_id", "o.leader").alias("b")).distinct())
        found = written(_verified(meet, busy, sets, percent), "links")
        edges = found if edges is None else edges.unionByName(found)
        labels = components(edges)
    left, parts = _mixed(_labelled(members, labels)), []
    for values in _levels():
        left = written(left.select("key", "class_id", "root", "size"), "mixed")
        parts.append(left.where(F.col("size") <= CROWD).select("key", "class_id", "root"))
        crowd = left.where(F.col("size") > CROWD)
        if crowd.isEmpty():
            left = None
            break
        deeper = (crowd.select("key", "class_id", "root").join(busy.select("class_id", "signature"), "class_id")
                  .select("class_id", "root", F.explode(_tree_keys(F.col("signature"), values, F.col("key"))).alias("key")))
        left = _mixed(_shared(deeper))
    if left is not None:  # the signature is used up; the blocks take what is left, whatever its size
        parts.append(left.select("key", "class_id", "root"))
    mixed = parts[0]
    for more in parts[1:]:
        mixed = mixed.unionByName(more)
    found = written(_grid(mixed, busy, sets, percent), "links")
    return labels if found.isEmpty() else components(edges.unionByName(found))


def _labelled_rows(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, text_key, n_shingles, class_id, root, component_id of every row."""
    signed = written(sign(docs, shingle), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    classes = written(signed.where("class_id is not null").groupBy("class_id").agg(
        first.alias("o"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")).select(
        "class_id", F.col("o.doc_id").alias("rep"), F.col("o.text_key").alias("rep_key"), "n", "signature"), "classes")
    labels = link_classes(docs, classes, shingle, percent)
    # A component's id is the smallest document id of its classes.
    linked = labels.join(classes.select(F.col("class_id").alias("node"), "rep"), "node")
    roots = linked.groupBy("root").agg(F.min("rep").alias("component"))
    of_class = classes.select("class_id", "rep").join(
        labels.join(roots, "root").select(F.col("node").alias("class_id"), "root", "component"), "class_id", "left")
    out = signed.drop("signature").join(of_class, "class_id", "left")
    return out.select(
        "doc_id", "text_key", "n_shingles", "class_id", F.coalesce("root", "class_id").alias("root"),
        F.when(F.col("class_id").isNull(), F.col("doc_id")).otherwise(F.coalesce("component", "rep")).alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    ``percent``: linked when 100 * |intersection| >= percent * |union|. ``kept`` is true where the
    id is its component's id (null-safe).
    """
    rows = _labelled_rows(docs, shingle, percent)
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component with all its columns: the smallest id, then the smallest hash of its text.

    Rows without words are no copies of each other and all stay, but for repeats of one id.
    """
    rows = _labelled_rows(docs, shingle, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("o")
    stay = rows.where("class_id is not null").groupBy("root").agg(first).select("o.doc_id", "o.text_key")
    stay = stay.unionByName(rows.where("class_id is null").select("doc_id", "text_key").distinct())
    stay = stay.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    key = free_name(docs.columns, "key_of")
    keyed = docs.withColumn(key, text_key())
    same = keyed["doc_id"].eqNullSafe(stay["_id"]) & (keyed[key] == stay["_key"])
    return keyed.join(stay, same, "left_semi").dropDuplicates(["doc_id", key]).drop(key)
