"""N-gram Jaccard join by relations between sets.

Every set's elements are put in one order, the rarest first; linked sets share an element among the first
n - ceil(threshold * n) + 1 of each, and only these are indexed. An index list is kept in blocks of equal cluster, size
class and position, and a pair of blocks is skipped where not even its smallest sizes could be linked from the largest
number of elements that may follow its positions. So sets are brought together cluster by cluster, and a list
of a thousand similar sets is one or a few rows.

A cluster holds the sets whose most frequent indexed element is the same. Of its sets, in blocks of at most `GROUP`, the
one nearest to the majority is the head. The head's overlaps with another block's sets are counted element by element;
those of the others are derived from them: what a set lacks of the head, or has beyond it, bounds its overlap, and
only where the bounds leave it open are these few elements looked up. Each pair of blocks gives the number of
links per set and one edge per linked set to its class inside the pair, never the pairs themselves, so links are all
found and counted, and the rows stay in proportion to the sets.

Of the elements, those with an even hash are counted and come first in the order, which any fixed order would do for;
most sets need no others. Equal sets are one node from the start, known by a 64-bit hash of its elements and told
apart by a second one: if two sets had the same first hash, another seed is taken.

Defined cases: a null or empty text, or one without words, has no element, is linked with nothing and is a class of its
own; so is a row with a null id; rows that repeat an id count as documents of their own, and the class's smallest
id stands for all; empty tables give empty results; columns of the input other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import LOWER, batches_by_size, few, gram_hashes, hashed, join_counted, joined, mix, sliced, stored, word_hashes
from .components import components

#: Sets of one block, elements of one block, and blocks that one head block is compared with in one run of rows.
GROUP, LARGE, RUN = 256, 2**20, 32
#: An element of more sets than this is frequent; classes of positions that blocks distinguish.
OFTEN, PLACES = 64, 8
_memo = word_hashes()


def elements(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word runs; a shorter text is one run."""
    own = text.encode().translate(LOWER).split() if text else []
    if not own:
        return np.empty(0, np.uint64)
    ids = hashed(own, _memo)
    if len(own) < words:
        return joined(gram_hashes(ids, len(own)), np.array([len(own)], np.uint64))
    return np.unique(gram_hashes(ids, words))


def node_of(items: np.ndarray, seed: int) -> int:
    return int(np.bitwise_xor.reduce(mix(items + np.uint64(seed))).view(np.int64))


def prefix_size(n: int, threshold: int) -> int:
    return n - -(-threshold * n // 100) + 1


def sets(docs: DataFrame, words: int, threshold: int, seed: int) -> DataFrame:
    """(id, node, two, n, counted, held): held are the elements that may be indexed, the first `counted` of them with even hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            node, two, n, counted, held = [], [], [], [], []
            for value in batch.column(1):
                items = elements(value.as_py(), words)
                n.append(len(items))
                if len(items):
                    even = items[items & np.uint64(1) == 0]
                    lacking = max(prefix_size(len(items), threshold) - len(even), 0)
                    node.append(node_of(items, seed))
                    two.append(int(mix(items ^ np.uint64(7)).sum(dtype=np.uint64).view(np.int64)))
                    counted.append(len(even))
                    held.append(np.concatenate((even, items[items & np.uint64(1) == 1][:lacking])).view(np.int64))
                else:
                    for column in (node, two, counted, held):
                        column.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (node, two, n, counted)), pa.array(held, pa.list_(pa.int64()))], names=["id", "node", "two", "n", "counted", "held"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {kind}, node long, two long, n long, counted long, held array<long>")


def postings(found: DataFrame, threshold: int) -> DataFrame:
    """(s, node, n, place): the elements among each node's first that other nodes have too.

    The rows of an element are read as one run: nodes that repeat are told by their place in it, and whether an
    element is frequent by the first OFTEN + 1 of its nodes, so no run is ever held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["s", "node", "n", "counted", "df"]
        kinds = [pa.int64()] * 4 + [pa.int32()]

        def out(rows: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip((*rows.T, df), kinds)], names=names)

        held, at, seen, last = np.empty((0, 4), np.int64), None, 0, None  # of the run that the last batch left open
        for batch in batches:
            rows = np.stack([c.to_numpy() for c in batch.columns], 1)
            if not len(rows):
                continue
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
            if last is not None:
                new[0] = (rows[0, :2] != last).any()
            last = rows[-1, :2].copy()
            rows = rows[new]
            if at is not None and seen > OFTEN:  # the open run is frequent
                more = int(np.searchsorted(rows[:, 0], at, "right"))
                if more:
                    yield out(rows[:more], np.full(more, OFTEN + 1, np.int32))
                rows = rows[more:]
                if not len(rows):
                    continue
            rows = np.concatenate((held, rows))
            if not len(rows):
                continue
            starts = np.flatnonzero(np.concatenate(([True], rows[1:, 0] != rows[:-1, 0])))
            sizes = np.diff(np.concatenate((starts, [len(rows)])))
            at, seen = rows[-1, 0], int(sizes[-1])
            df = np.repeat(np.minimum(sizes, OFTEN + 1), sizes).astype(np.int32)
            keep = df > 1
            if seen <= OFTEN:  # wait for the rest of the last run
                held = rows[starts[-1] :].copy()
                keep[starts[-1] :] = False
            else:
                held = np.empty((0, 4), np.int64)
            if keep.any():
                yield out(rows[keep], df[keep])
        if len(held) > 1:
            yield out(held, np.full(len(held), len(held), np.int32))

    rows = found.where("node IS NOT NULL").select(F.explode("held").alias("s"), "node", "n", "counted")
    shared = rows.repartition("s").sortWithinPartitions("s", "node").mapInArrow(run, "s long, node long, n long, counted long, df int")
    # the order: counted ones first, the rarest in front; what no other node has stands before what some have
    own = shared.groupBy("node").agg(F.first("n").alias("n"), F.first("counted").alias("counted"), F.sort_array(F.collect_list(F.struct(F.col("s").bitwiseAND(1).alias("odd"), "df", "s"))).alias("x"))
    evens = F.size(F.filter("x", lambda x: x["odd"] == 0))
    place = F.transform("x", lambda x, i: F.struct(x["s"].alias("s"), F.when(x["odd"] == 0, F.col("counted") - F.col("evens") + i).otherwise(F.col("counted")).alias("place")))
    size = F.col("n") - F.ceil(F.col("n") * threshold / 100) + 1
    out = own.withColumn("evens", evens).select("node", "n", size.alias("p"), F.explode(place).alias("x"))
    return stored(out.select("x.s", "node", "n", F.col("x.place").alias("place"), "p").where("place < p").drop("p"))


def clusters(index: DataFrame) -> DataFrame:
    """(node, n, cluster): the element of the node's index entries that most nodes have."""
    count = stored(index.groupBy("s").agg(F.count("*").alias("m")).where("m > 1"))
    return stored(join_counted(index, count, ["s"], "m").groupBy("node").agg(F.first("n").alias("n"), F.max_by("s", F.struct("m", "s")).alias("cluster")))


def cluster_pairs(index: DataFrame, member: DataFrame, threshold: int) -> DataFrame:
    """(a, b), a <= b: clusters of which sets may be linked."""
    klass = F.floor(F.log(F.col("n").cast("double")) * 16)
    place = F.floor(F.col("place") * PLACES * 100 / (F.col("n") * (100 - threshold) + 100))
    blocks = index.join(member.select("node", "cluster"), "node").groupBy("s", "cluster", klass.alias("klass"), place.alias("step")).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("place")).alias("rest"))
    blocks = stored(blocks)
    mixed = blocks.groupBy("s").agg(F.min("cluster").alias("least"), F.max("cluster").alias("most")).where("least <> most").select("s")
    blocks = stored(blocks.join(few(stored(mixed)), "s", "left_semi").select("s", "cluster", "low", "high", "rest"))
    other = blocks.select("s", F.col("cluster").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.col("rest").alias("rest_b"))
    both = blocks.join(other, "s").where(F.col("cluster") < F.col("b"))
    fits = (F.lit(100) * F.col("high") >= F.lit(threshold) * F.col("low_b")) & (F.lit(100) * F.col("high_b") >= F.lit(threshold) * F.col("low"))
    reach = F.lit(100 + threshold) * F.least("rest", "rest_b") >= F.lit(threshold) * (F.col("low") + F.col("low_b"))
    pairs = both.where(fits & reach).select(F.col("cluster").alias("a"), "b").distinct()
    return pairs.union(member.groupBy("cluster").agg(F.count("*").alias("m")).where("m > 1").select("cluster", "cluster"))


def compared(heads: list[np.ndarray], others: list[np.ndarray], threshold: int) -> np.ndarray:
    """Which of the heads are linked with which of the others."""
    words, times = np.unique(np.concatenate(heads), return_counts=True)
    usual = words[2 * times > len(heads)]
    near = [2 * len(np.intersect1d(h, usual, assume_unique=True)) - len(h) for h in heads]
    head = heads[int(np.argmax(near))]
    flat, sizes = np.concatenate(others), np.array([len(o) for o in others])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    place = np.minimum(np.searchsorted(head, flat), len(head) - 1)
    answer = np.add.reduceat((head[place] == flat).astype(np.int64), starts)  # the head's overlap with each other
    lacks = [np.setdiff1d(head, h, assume_unique=True) for h in heads]
    extra = [np.setdiff1d(h, head, assume_unique=True) for h in heads]
    own = np.array([len(h) for h in heads])
    need = -(-threshold * (own[:, None] + sizes) // (100 + threshold))
    low = answer - np.array([len(x) for x in lacks])[:, None]
    high = np.minimum(answer + np.array([len(x) for x in extra])[:, None], np.minimum(own[:, None], sizes))
    linked = low >= need
    unsure = ~linked & (high >= need)
    rows, columns = np.flatnonzero(unsure.any(1)), np.flatnonzero(unsure.any(0))
    if len(rows) and len(columns):
        flat = np.concatenate([others[c] for c in columns])
        of = np.repeat(np.arange(len(columns)), sizes[columns])
        words = np.unique(np.concatenate([x for r in rows for x in (lacks[r], extra[r])]))
        words = words[np.isin(words, flat)]  # the others never turn the scale
        change = np.zeros((len(rows), len(columns)), np.float32)
        for k in range(0, len(words), 4096):
            part = words[k : k + 4096]
            ours, theirs = np.zeros((len(rows), len(part)), np.float32), np.zeros((len(columns), len(part)), np.float32)
            for i, r in enumerate(rows):
                for sign, x in ((-1, lacks[r]), (1, extra[r])):
                    x = x[np.searchsorted(x, part[0]) : np.searchsorted(x, part[-1], "right")]
                    at = np.minimum(np.searchsorted(part, x), len(part) - 1)
                    ours[i, at[part[at] == x]] = sign
            at = np.minimum(np.searchsorted(part, flat), len(part) - 1)
            some = part[at] == flat
            theirs[of[some], at[some]] = 1
            change += ours @ theirs.T
        exact = answer[columns] + change.astype(np.int64)
        at = np.ix_(rows, columns)
        linked[at] |= unsure[at] & (exact >= need[at])
    return linked


def classes_of(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for the class of each row and column; equal numbers: connected."""
    rows, columns = np.arange(linked.shape[0]), np.full(linked.shape[1], linked.shape[0])
    while True:
        far = np.where(linked, rows[:, None], linked.shape[0]).min(0, initial=linked.shape[0])
        columns = np.minimum(columns, far)
        near = np.minimum(rows, np.where(linked, columns, linked.shape[0]).min(1, initial=linked.shape[0]))
        if (near == rows).all():
            return rows, columns
        rows = near


def verified(docs: DataFrame, member: DataFrame, pairs: DataFrame, heads: DataFrame, words: int, threshold: int, seed: int, repeats: bool) -> DataFrame:
    """(node, links, to): for each linked node and pair of blocks, the documents that it is linked with, and one of its class.

    repeats: whether rows of docs may repeat an id.
    """
    own = member.join(heads.select("node", "m", "id"), "node")
    total = stored(own.groupBy("cluster").agg(F.count("*").alias("c"), F.sum("n").alias("size")).withColumn("blocks", F.ceil(F.greatest(F.col("c") / GROUP, F.col("size") / LARGE))).select("cluster", "blocks", "c"))
    dealt = join_counted(own, total, ["cluster"], "c").select("id", "node", "m", "cluster", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 200):
            held = [elements(v.as_py(), words) for v in batch.column(4)]
            own = pa.array([len(x) > 0 and node_of(x, seed) == node for x, node in zip(held, batch.column(0).to_pylist())])  # rows that repeat an id have texts of their own
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([x.tobytes() for x in held], pa.binary())], names=["node", "m", "cluster", "block", "held"]).filter(own)

    full = docs.join(few(stored(dealt)), "id").select("node", "m", "cluster", "block", "text").mapInArrow(run, "node long, m long, cluster long, block long, held binary")
    full = stored(full.dropDuplicates(["node"]) if repeats else full)
    sizes = total.select("cluster", "blocks")
    units = pairs.join(sizes.select(F.col("cluster").alias("a"), F.col("blocks").alias("n_a")), "a").join(sizes.select(F.col("cluster").alias("b"), F.col("blocks").alias("n_b")), "b")
    units = units.select("a", "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_a") - 1)).alias("block_a"), "n_b").select("a", "b", "block_a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_b") - 1)).alias("block_b"))
    units = stored(units.where("a <> b OR block_a <= block_b"))
    runs = stored(units.groupBy("a", "block_a").agg(F.count("*").alias("c")))
    units = stored(join_counted(units, runs, ["a", "block_a"], "c").select("a", "block_a", "b", "block_b", F.pmod(F.xxhash64("b", "block_b"), F.ceil(F.col("c") / RUN)).alias("salt")))
    first = units.select("a", "block_a", "salt").distinct().withColumn("role", F.lit(0)).withColumn("b", F.col("a")).withColumn("block_b", F.col("block_a"))
    asked = few(stored(first.unionByName(units.withColumn("role", F.lit(1)))))
    shipped = asked.join(full.select(F.col("cluster").alias("b"), F.col("block").alias("block_b"), "node", "m", "held"), ["b", "block_b"])
    rows = shipped.select("a", "block_a", "salt", "role", "b", "block_b", "node", "m", "held").repartition("a", "block_a", "salt").sortWithinPartitions("a", "block_a", "salt", "role", "b", "block_b")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows):
            return np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), [np.frombuffer(r[2], np.uint64) for r in rows]

        def out(head, other, same):
            linked = compared(head[2], other[2], threshold)
            if same:
                linked &= head[0][:, None] < other[0]
            if not linked.any():
                return None
            rows, columns = classes_of(linked)
            r, c = linked.any(1), linked.any(0)
            names = np.concatenate((head[0][r], other[0][c]))
            links = np.concatenate((linked[r] @ other[1], (linked.T[c]) @ head[1]))
            to = head[0][np.concatenate((rows[r], columns[c]))]
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(links.astype(np.int64)), pa.array(to)], names=["node", "links", "to"])

        unit, part, head, held = None, None, None, []
        for batch in sliced(batches, 200):
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(6))))
            for key, node, m, items in zip(keys, batch.column(6).to_pylist(), batch.column(7).to_pylist(), batch.column(8).to_pylist()):
                if key != part:
                    if held:
                        if part[3] == 0:
                            head = block(held)
                        elif (found := out(head, block(held), part[4:] == part[:2])) is not None:
                            yield found
                    part, held = key, []
                held.append((node, m, items))
        if held and part[3] == 1 and (found := out(head, block(held), part[4:] == part[:2])) is not None:
            yield found

    return stored(rows.mapInArrow(judge, "node long, links long, to long"))


def joined_sets(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", words: int = 5, threshold: int = 80) -> DataFrame:
    """(id_col, n_shingles, component_id, n_links) of every document.

    Linked: 100 * intersection >= threshold * union. component_id: the smallest id that links reach; n_links: the
    other documents that the document is linked with.
    """
    batches_by_size(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    for seed in range(1, 9):
        found = stored(sets(docs, words, threshold, seed))
        heads = stored(found.where("id IS NOT NULL AND node IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("m"), F.max("n").alias("n"), (F.min(F.struct("n", "two")) != F.max(F.struct("n", "two"))).alias("mixed")))
        if heads.where("mixed").isEmpty():
            break
    index = postings(found.where("id IS NOT NULL"), threshold)
    member = clusters(index)
    pairs = stored(cluster_pairs(index, member, threshold))
    repeats = not found.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("c")).where("c > 1").isEmpty()
    links = verified(docs, member, pairs, heads, words, threshold, seed, repeats)
    count = links.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(links.select(F.col("node").alias("a"), F.col("to").alias("b")))
    own = heads.join(few(classes), "node", "left").join(few(stored(count)), "node", "left").select("node", "id", "m", "comp", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"))
    least = stored(own.where("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("component"), F.count("*").alias("c")))
    some = join_counted(own.where("comp IS NOT NULL"), least, ["comp"], "c").select("node", "m", "component", "n_links")
    own = stored(some.union(own.where("comp IS NULL").select("node", "m", "id", "n_links")))
    skinny = found.select("id", "n", "node")
    fine = F.col("id").isNotNull() & F.col("node").isNotNull()
    out = join_counted(skinny.where(fine), own, ["node"], "m").select("id", "n", "component", "n_links")
    out = out.union(skinny.where(~fine).select("id", "n", "id", F.lit(0).cast("long")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "n_links")


def op11_set_join(spark, sf_dir: str) -> DataFrame:
    return joined_sets(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(0, len(w) - 4), lambda i: array_to_string(list_slice(w, i + 1, i + 5), ' ')) END) AS s FROM doc),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
multi AS (SELECT s FROM shingle GROUP BY s HAVING count(*) > 1),
shared AS MATERIALIZED (SELECT * FROM shingle SEMI JOIN multi USING (s)),
inter AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shared a JOIN shared b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM inter JOIN size x ON a = x.doc_id JOIN size y ON b = y.doc_id WHERE 100 * i >= 80 * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM doc UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
comp AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a),
degree AS (SELECT a AS doc_id, count(*) AS k FROM both_ways GROUP BY a)
SELECT doc.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, coalesce(k, 0)::BIGINT AS n_links
FROM doc LEFT JOIN size USING (doc_id) JOIN comp USING (doc_id) LEFT JOIN degree USING (doc_id)
"""
