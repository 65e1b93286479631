"""SimHash near duplicates: fingerprints of word shingles, a binary trie joined with itself, connected components.

The trie of all fingerprints is cut into subtrees of bounded size. Node pairs are followed down from the root pair by
some bits at a time, and dropped once their prefixes differ in more bits than allowed; what is left are pairs of
subtrees, which tasks join bit by bit in the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.common import documents, fresh, name, stored
from scoreloom.session import materialise

SHINGLE, SEED, BITS, MAX_BITS = 3, 42, 64, 2
#: Fingerprints in a subtree at most, bits by which the cut goes down, node pairs that a task holds at once.
SUBTREE, STEP, PAIRS = 16_384, 2, 200_000
#: Range pairs with at most so many fingerprint pairs are compared directly.
DIRECT = 64
MAX_ROUNDS = 100


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z, and ASCII white space
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        some = words[at : min(n, at + (1 << 16)) + shingle - 1]
        shingles = map(b" ".join, zip(*(some[i:] for i in range(min(shingle, len(words)))), strict=False))
        hashes = b"".join([digest(s, SEED) for s in shingles])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(text: Column, shingle: int) -> Column:
    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).astype(np.int64))

    return of(text)


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def trie_join(a: np.ndarray, b: np.ndarray | None, budget: int = MAX_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of places (i, j) with at most `budget` bits between a[i] and b[j], both sorted; b None: a with itself, i < j.

    A node is a range of a sorted array. A pair of nodes goes to the pairs of their children, for the next bit, with
    one more differing bit if these take different sides, until the budget is exceeded.
    """
    same = b is None
    b = a if same else b
    # Each entry: bit below which the nodes are equal or counted, and arrays of a-range, b-range, differing bits.
    stack = [(BITS, *(np.array([v]) for v in (0, len(a), 0, len(b), 0)))]
    while stack:
        bit, alo, ahi, blo, bhi, err = stack.pop()
        if len(err) > PAIRS:
            half = len(err) // 2
            stack += [(bit, *(x[half:] for x in (alo, ahi, blo, bhi, err))), (bit, *(x[:half] for x in (alo, ahi, blo, bhi, err)))]
            continue
        product = (ahi - alo) * (bhi - blo)
        small = product <= DIRECT if bit else product > 0
        if small.any():
            yield from _direct(a, b, *(x[small] for x in (alo, ahi, blo, bhi)), product[small], same, budget)
        alo, ahi, blo, bhi, err = (x[~small] for x in (alo, ahi, blo, bhi, err))
        if not len(err):
            continue
        bit -= 1
        amid, bmid = _middle(a, alo, ahi, bit), _middle(b, blo, bhi, bit)
        sides = [(alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1), (amid, ahi, blo, bmid, err + 1)]
        below = []
        for side in sides:
            keep = (side[1] > side[0]) & (side[3] > side[2]) & (side[4] <= budget)
            if same:
                keep &= side[0] < side[3]  # the pair the other way round is followed too
            below.append([x[keep] for x in side])
        stack.append((bit, *(np.concatenate(x) for x in zip(*below, strict=True))))


def _middle(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where, in each range of equal higher bits, the values with this bit begin."""
    first = values[lo] >> np.uint64(bit) | np.uint64(1)
    return np.clip(np.searchsorted(values, first << np.uint64(bit)), lo, hi)


def _direct(a, b, alo, ahi, blo, bhi, product, same, budget) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ends = np.cumsum(product)
    for begin in range(0, len(product), PAIRS):
        some = slice(begin, begin + PAIRS)
        n = product[some]
        at = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(at)) - np.repeat(ends[some] - n - (ends[begin] - n[0]), n)
        width = (bhi - blo)[some][at]
        i, j = alo[some][at] + k // width, blo[some][at] + k % width
        keep = np.bitwise_count(a[i] ^ b[j]) <= budget
        if same:
            keep &= i < j
        if keep.any():
            yield i[keep], j[keep]


class Union:
    """Smallest member of each set, over places of an array."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        """Join pairs; by repeated minima, so that it is array work."""
        while True:
            a, b = self._find(i), self._find(j)
            differ = a != b
            if not differ.any():
                return
            a, b = a[differ], b[differ]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))

    def _find(self, i: np.ndarray) -> np.ndarray:
        at = self.root[i]
        while not np.array_equal(up := self.root[at], at):
            at = up
        self.root[i] = at
        return at

    def roots(self) -> np.ndarray:
        return self._find(np.arange(len(self.root)))


def _prefix(fp: Column, depth: int) -> Column:
    """The first `depth` bits, at least one, and zeros after them."""
    return fp.bitwiseAND(F.lit(-1 << (BITS - depth)))


def subtrees(fps: DataFrame, most: int = SUBTREE, step: int = STEP, budget: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(fps with cell and depth, pairs of cells): the trie cut into subtrees of at most `most` fingerprints.

    Pairs are (cell_a, depth_a, cell_b, depth_b), cell_a not above cell_b, whose prefixes differ in at most `budget`.
    """
    spark = fps.sparkSession
    total = fps.count()
    pairs = spark.createDataFrame([(0, 0, 0, 0)], "a long, da int, b long, db int")
    open_ = spark.createDataFrame([(0,)], "parent long") if total > most else None
    placed = fps.withColumns({"cell": F.lit(0).cast("long"), "depth": F.lit(0)})
    depth = 0
    while open_ is not None and depth < BITS:
        deep = depth + step
        inside = placed.filter(F.col("depth") == depth).join(open_.withColumnRenamed("parent", "cell"), "cell", "left_semi")
        nodes = inside.groupBy("cell", _prefix(F.col("fp"), deep).alias("child")).agg(F.count("*").alias("n"))
        nodes = stored(nodes.withColumnRenamed("cell", "parent"), "trie-nodes")
        split = nodes.select("parent").distinct().withColumn("split", F.lit(True))
        # A subtree that is not cut any further stays as its own child.
        placed = placed.join(split.withColumnRenamed("parent", "cell").withColumn("depth", F.lit(depth)), ["cell", "depth"], "left").select(
            "fp",
            F.when(F.col("split"), _prefix(F.col("fp"), deep)).otherwise(F.col("cell")).alias("cell"),
            F.when(F.col("split"), deep).otherwise(F.col("depth")).alias("depth"),
        )
        placed = stored(placed, "trie-cells")
        for side in "ab":
            below = nodes.select(F.col("parent").alias(side), F.lit(depth).alias("d" + side), F.col("child").alias("child"))
            pairs = pairs.join(below, [side, "d" + side], "left").withColumns(
                {
                    "d" + side: F.when(F.col("child").isNotNull(), deep).otherwise(F.col("d" + side)),
                    side: F.coalesce("child", side),
                }
            ).drop("child")
        common = F.expr(f"if(least(da, db) = 0, 0L, shiftleft(-1L, {BITS} - least(da, db)))")
        differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")).bitwiseAND(common))
        pairs = stored(pairs.filter((differing <= budget) & (F.col("a") <= F.col("b"))), "trie-pairs")
        large = nodes.filter(F.col("n") > most).select(F.col("child").alias("parent"))
        open_ = None if large.isEmpty() else large
        depth = deep
    return placed, pairs


LINKS = pa.schema([("low", pa.int64()), ("high", pa.int64())])


def _spanning(a: np.ndarray, b: np.ndarray | None, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components within a pair of subtrees: each fingerprint to the smallest place of its component."""
    values = a if b is None else np.concatenate([a, b])
    union = Union(len(values))
    for i, j in trie_join(a, b, budget):
        union.link(i, j if b is None else j + len(a))
    root = union.roots()
    linked = np.flatnonzero(root != np.arange(len(root)))
    return values[root[linked]], values[linked]


def _links(budget: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sorted_(column: pa.Array, i: int) -> np.ndarray | None:
        return np.sort(column[i].values.to_numpy(zero_copy_only=False).astype(np.uint64)) if column[i].is_valid else None

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                low, high = _spanning(sorted_(batch["fps_a"], i), sorted_(batch["fps_b"], i), budget)
                yield pa.RecordBatch.from_arrays([pa.array(low.astype(np.int64)), pa.array(high.astype(np.int64))], schema=LINKS)

    return of


def links(fps: DataFrame, most: int = SUBTREE, budget: int = MAX_BITS) -> DataFrame:
    """(low, high): links that connect all fingerprints (distinct `fp`) within `budget` bits of each other.

    A subtree travels as one array, to each pair that it is in; a pair with itself as second has none.
    """
    placed, pairs = subtrees(fps, most, budget=budget)
    packed = stored(placed.groupBy("cell", "depth").agg(F.collect_list("fp").alias("fps")), "subtrees")
    a = packed.select(F.col("cell").alias("a"), F.col("depth").alias("da"), F.col("fps").alias("fps_a"))
    b = packed.select(F.col("cell").alias("b"), F.col("depth").alias("db"), F.col("fps").alias("fps_b"))
    other = pairs.filter((F.col("a") != F.col("b")) | (F.col("da") != F.col("db"))).join(a, ["a", "da"]).join(b, ["b", "db"])
    own = a.select(F.col("a").alias("b"), F.col("da").alias("db"), "a", "da", "fps_a", F.lit(None).cast("array<long>").alias("fps_b"))
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = other.unionByName(own).repartition(tasks, "a", "da", "b", "db")
    return dealt.select("fps_a", "fps_b").mapInArrow(_links(budget), "low long, high long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (low, high) is connected with.

    Each round takes the smallest label of a node's neighbours, then the label of its label. An edge list is joined
    with labels by node only, whose degree is bounded; labels shared by many rows are joined as the larger side.
    """
    both = edges.select(F.col("low").alias("node"), F.col("high").alias("other")).union(edges.select("high", "low")).distinct()
    both = materialise(both)
    labels = materialise(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")))
    for _ in range(MAX_ROUNDS):
        seen = both.join(labels.withColumnRenamed("node", "other"), "other").select("node", "root")
        near = seen.union(labels).groupBy("node").agg(F.min("root").alias("root"))
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = near.join(up, "root").select("node", F.least("root", "up").alias("root"))
        new = materialise(jumped)
        if new.join(labels, ["node", "root"], "left_anti").isEmpty():
            return new
        labels = new
    raise RuntimeError("components did not settle")


def grouped(rows: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """Adds root, a fingerprint for each component, and component_id, its smallest doc_id, to stored rows (doc_id, fp, ...)."""
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = components(stored(links(classes.select("fp"), budget=budget), "links"))
    roots = found.select(F.col("node").alias("fp"), "root")
    near = stored(classes.join(roots, "fp").select("fp", "root", "least"), "near")
    least = near.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(near.join(least, "root").select("fp", "root", "component_id"), "named")
    whole = classes.join(named, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")
    )
    return rows.join(stored(whole, "components"), "fp")


def fingerprinted(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    return stored(documents(docs).select("doc_id", _fingerprints(F.col("text"), shingle).alias("fp")), "fingerprints")


def linked(docs: DataFrame, shingle: int = SHINGLE, budget: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of (doc_id, text).

    Fingerprints are made of shingles of `shingle` words and linked if at most `budget` bits differ.

    Texts without words, null and empty ones too, have fingerprint zero and are linked like any other. Null ids stay
    and take part; a component of null ids alone has a null component_id. An empty table gives no rows; other columns
    are left out.
    """
    return grouped(fingerprinted(docs, shingle), budget).select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, budget: int = MAX_BITS) -> DataFrame:
    """One row of each component of `linked`, that with its smallest doc_id, with all its columns and nothing else.

    Of several rows with that id that with the smallest hash of its text stays, and of repeated ones any. Texts without
    words are one component. Rows with null ids stay only where no other row of their component has an id. Texts are
    shuffled once, by id, to be joined with those that stay.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    id_, hash_ = F.coalesce(doc_id, F.lit(-1 << 63)), F.xxhash64(text)
    rows = stored(docs.select(doc_id.alias("doc_id"), id_.alias("id"), hash_.alias("hash"), _fingerprints(text, shingle).alias("fp")), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "id", "hash"))
    best = grouped(rows, budget).groupBy("root").agg(first.alias("best"))
    mark, hash_mark, row = (fresh(docs, c) for c in ("mark_id", "mark_hash", "mark_row"))
    kept = stored(best.select(F.col("best.id").alias(mark), F.col("best.hash").alias(hash_mark)), "kept")
    marked = docs.withColumns({mark: id_, hash_mark: hash_}).join(kept, [mark, hash_mark], "left_semi")
    one = Window.partitionBy(mark, hash_mark).orderBy(mark, hash_mark)
    return marked.withColumn(row, F.row_number().over(one)).filter(name(row) == 1).select(*[name(c) for c in docs.columns])
