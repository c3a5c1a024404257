"""Near-duplicate classes by min-max hashing.

Each of `hashes` permutations of a document's shingle set gives two signature values, its minimum and its maximum, so
half the hash evaluations make a signature of full length. Bands of `rows` values bring documents together; links are
confirmed on the full sets.

Documents with equal sets are one node. Inside a band's bucket, pairs aren't listed: every member is compared with one
pivot, then the members that are still apart with the one that has most common shingles. What that leaves apart is
settled exactly by prefixes: of two linked sets, put in order from the rarest shingle to the commonest, the first
n - ceil(threshold * n) + 1 of each share one, so only nodes of different components that share such a shingle, and
whose sizes and places in the order allow the link, are compared. Where the first shingle that two sets share is a
common one, all that they share are: then they must also lie in one bucket and hold common shingles enough.

Defined cases: a null or empty text, or one without words, has no shingle, is linked with nothing and kept; so is a
row with a null id, whose component is null; rows that repeat an id belong to one class with all their texts; ties go
to the smallest id; empty tables give empty results; columns of the input that bear an added column's name are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import BROADCAST_ROWS, LOWER, few, gram_hashes, hashed, join_counted, joined, mix, sliced, stored, without, word_hashes
from .components import components

HASHES, ROWS = 75, 5
#: A shingle of more open nodes than this is common.
RARE = 64
#: Members of one pivot that are compared in one group of rows, and nodes of one shingle that one task pairs with others.
GROUP, BLOCK = 256, 512
_memo = word_hashes()


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle."""
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    ids = hashed(words, _memo)
    if len(words) < shingle:
        return joined(gram_hashes(ids, len(words)), np.array([len(words)], np.uint64))
    return np.unique(gram_hashes(ids, shingle))


def permutations(n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.random.default_rng(seed).integers(0, 2**64, (2, n), np.uint64)
    return numbers[0] | np.uint64(1), numbers[1]


def bands(items: np.ndarray, a: np.ndarray, b: np.ndarray, rows: int) -> np.ndarray:
    """A key per band of the signature: all minima, then all maxima."""
    low, high = np.full(len(a), 2**64 - 1, np.uint64), np.zeros(len(a), np.uint64)
    for at in range(0, len(items), 2048):
        values = items[at : at + 2048] * a[:, None] + b[:, None]
        low, high = np.minimum(low, values.min(1)), np.maximum(high, values.max(1))
    signature = np.concatenate((low, high)).reshape(-1, rows)
    keys = np.arange(len(signature), dtype=np.uint64)
    for k in range(rows):
        keys = joined(keys, signature[:, k])
    return keys.view(np.int64)


def text_mark(text: str):
    """A hash that tells the texts of rows that repeat an id apart."""
    return F.coalesce(F.xxhash64(text), F.lit(0))


def signatures(docs: DataFrame, id_col: str, text: str, shingle: int, hashes: int, rows: int) -> DataFrame:
    """(id, th, n_shingles, one, two, keys) of each document: mark of the text, two hashes of the set, and the bands' keys."""
    a, b = permutations(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sizes, one, two, keys = [], [], [], []
            for value in batch.column(2):
                items = shingle_set(value.as_py(), shingle)
                sizes.append(len(items))
                one.append(int(np.bitwise_xor.reduce(mix(items)).view(np.int64)) if len(items) else None)
                two.append(int(mix(items ^ np.uint64(7)).sum(dtype=np.uint64).view(np.int64)) if len(items) else None)
                keys.append(bands(items, a, b, rows) if len(items) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["id", "th", "n_shingles", "one", "two", "keys"])

    fields = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in ("th", "n_shingles", "one", "two")), T.StructField("keys", T.ArrayType(T.LongType()))])
    return docs.select(F.col(id_col).alias("id"), text_mark(text).alias("th"), F.col(text).alias("text")).mapInArrow(run, fields)


def fetched(docs: DataFrame, nodes: DataFrame, need: DataFrame) -> DataFrame:
    """need (node, ...) with the texts of docs (id, th, text); need is broadcast when it is small, else both sides shuffle."""
    return docs.join(few(stored(need.join(few(nodes.select("node", "id", "th")), "node"))), ["id", "th"])


def confirmed(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int, threshold: int) -> DataFrame:
    """Those of the pairs (a, b) of nodes whose full sets have a Jaccard similarity of at least threshold percent."""
    groups = stored(pairs.groupBy("a").agg(F.count("*").alias("_n")))
    dealt = stored(join_counted(pairs, groups, ["a"], "_n").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("_n") / GROUP)).cast("int").alias("salt")))
    heads = dealt.select(F.col("a").alias("node"), "a", "salt", F.lit(0).alias("role")).distinct()
    need = heads.unionByName(dealt.select(F.col("b").alias("node"), "a", "salt", F.lit(1).alias("role")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, head = None, np.empty(0, np.uint64)
        for batch in sliced(batches):
            a, salt, role, node = (batch.column(k).to_pylist() for k in range(4))
            out: list[tuple] = []
            for k, value in enumerate(batch.column(4)):
                own = shingle_set(value.as_py(), shingle)
                if role[k] == 0:
                    at, head = (a[k], salt[k]), own
                elif at == (a[k], salt[k]) and len(own) and len(head):
                    place = np.minimum(np.searchsorted(head, own), len(head) - 1)
                    shared = int((head[place] == own).sum())
                    if 100 * shared >= threshold * (len(head) + len(own) - shared):
                        out.append((a[k], node[k]))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"])

    rows = fetched(docs, nodes, need).select("a", "salt", "role", "node", "text").repartition("a", "salt").sortWithinPartitions("a", "salt", "role", "node")
    return stored(rows.mapInArrow(run, "a long, b long"))


def open_members(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, node, comp, m) of the buckets of three or more members that hold several components; m: members."""
    own = members.join(few(classes.select(F.col("node").alias("_n"), "comp")), F.col("node") == F.col("_n"), "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    some = own.groupBy("key", "comp").agg(F.count("*").alias("m")).groupBy("key").agg(F.count("*").alias("comps"), F.sum("m").alias("m")).where("comps > 1 AND m > 2").select("key", "m")
    return stored(join_counted(own, stored(some), ["key"], "m"))


def prefixes(docs: DataFrame, nodes: DataFrame, opened: DataFrame, shingle: int, threshold: int) -> DataFrame:
    """(node, n, common, prefix) of the open nodes.

    common: how many of the n shingles stand in more than RARE of them. prefix: those of the first n - ceil(threshold
    * n) + 1 shingles, from the rarest on, that stand in several, as structs (place in the order, s, often: common).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for node, value in zip(batch.column(0), batch.column(1)):
                items = shingle_set(value.as_py(), shingle)
                if len(items):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(items), node.as_py())), pa.array(items.view(np.int64))], names=["node", "s"])

    rows = stored(fetched(docs, nodes, opened.select("node").distinct()).select("node", "text").mapInArrow(run, "node long, s long"))
    often = stored(rows.groupBy("s").agg(F.count("*").alias("df")).where("df > 1"))
    # a set, since rows that repeat both id and text are read twice
    held = join_counted(rows, often, ["s"], "df").groupBy("node").agg(F.sort_array(F.collect_set(F.struct("df", "s"))).alias("shared"))
    held = nodes.select("node", "n").join(held, "node").withColumn("first", F.col("n") - F.size("shared"))
    place = F.transform("shared", lambda x, i: F.struct((F.col("first") + i).alias("place"), x["s"].alias("s"), (x["df"] > RARE).alias("often")))
    # whole numbers: n - ceil(threshold * n / 100) + 1 - first
    size = F.greatest(F.floor(F.col("n") * (100 - threshold) / 100).cast("int") + 1 - F.col("first").cast("int"), F.lit(0))
    common = F.size(F.filter("shared", lambda x: x["df"] > RARE))
    return stored(held.select("node", "n", common.alias("common"), F.slice(place, F.lit(1), size).alias("prefix")))


def in_blocks(rows: DataFrame, on: str, columns: list[str], apart) -> DataFrame:
    """Pairs of rows with equal `on` for which `apart` holds, their columns with _a and _b. A frequent key is dealt in blocks."""
    counted = rows.groupBy(on).agg(F.count("*").alias("m")).where("m > 1")
    rows = stored(join_counted(rows, stored(counted), [on], "m").withColumn("blocks", F.ceil(F.col("m") / BLOCK)))
    left = rows.select(on, *(F.col(c).alias(f"{c}_a") for c in columns), F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))
    right = rows.select(on, *(F.col(c).alias(f"{c}_b") for c in columns), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    return left.join(right, [on, "block"]).where((F.col("node_a") < F.col("node_b")) & apart)


def prefix_pairs(members: DataFrame, opened: DataFrame, threshold: int) -> DataFrame:
    """(a, b): nodes of different components that may be linked, from (node, comp, n, common, prefix) and buckets (key, node)."""
    apart = (F.col("comp_a") != F.col("comp_b")) & (F.lit(100) * F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b"))
    rare = stored(members.select("node", "comp", "n", F.explode(F.filter("prefix", lambda x: ~x["often"])).alias("x")).select("node", "comp", "n", "x.place", "x.s"))
    mixed = rare.groupBy("s").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most").select("s")
    pairs = in_blocks(rare.join(few(stored(mixed)), "s", "left_semi"), "s", ["node", "comp", "n", "place"], apart)
    # from the first shingle that they share on, no more than the shorter rest can be shared
    pairs = pairs.groupBy("node_a", "node_b").agg(F.min_by(F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")), "place_a").alias("rest"), (F.first("n_a") + F.first("n_b")).alias("n"))
    pairs = pairs.where(F.lit(100) * F.col("rest") >= F.lit(threshold) * (F.col("n") - F.col("rest"))).select("node_a", "node_b")
    often = members.select("node", "comp", "n", "common", F.transform(F.filter("prefix", lambda x: x["often"]), lambda x: x["s"]).alias("often"))
    often = often.where((F.size("often") > 0) & (F.lit(100) * F.col("common") >= F.lit(threshold) * F.col("n")))
    least = F.least("common_a", "common_b")
    enough = (F.lit(100) * least >= F.lit(threshold) * (F.col("n_a") + F.col("n_b") - least)) & F.arrays_overlap("often_a", "often_b")
    more = in_blocks(opened.select("key", "node").join(few(stored(often)), "node"), "key", ["node", "comp", "n", "common", "often"], apart & enough)
    return pairs.union(more.select("node_a", "node_b")).distinct().select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def repeated_ids(found: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """Links (a, b) between the nodes that rows of one id belong to, if an id repeats."""
    again = stored(found.where("id IS NOT NULL AND one IS NOT NULL").groupBy("id").agg(F.count("*").alias("m")).where("m > 1"))
    if again.isEmpty():
        return None
    rows = join_counted(found.select("id", "one", "two", "n_shingles").where("one IS NOT NULL"), again, ["id"], "m")
    sets = nodes.select("one", "two", F.col("n").alias("n_shingles"), "node", F.col("m").alias("_m"))
    own = stored(join_counted(rows, sets, ["one", "two", "n_shingles"], "_m").select("id", "node").distinct())
    least = stored(own.groupBy("id").agg(F.min("node").alias("a"), F.count("*").alias("m")).where("m > 1"))
    return join_counted(own, least, ["id"], "m").select("a", F.col("node").alias("b"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", shingle: int = 5, threshold: int = 80, hashes: int = HASHES, rows: int = ROWS) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) of every document.

    Linked: 100 * intersection >= threshold * union of the shingle sets. component_id: the smallest id that links
    reach. With the defaults a pair at similarity 0.8 misses all bands with a chance under 1e-5; 60 hashes do for 0.85
    (under 1e-6).
    """
    found = stored(signatures(docs, id_col, text, shingle, hashes, rows))
    docs = docs.select(F.col(id_col).alias("id"), text_mark(text).alias("th"), F.col(text).alias("text")).where("id IS NOT NULL")
    sets = found.where("id IS NOT NULL AND one IS NOT NULL")
    heads = sets.groupBy("one", "two", "n_shingles").agg(F.min(F.struct("id", "th")).alias("head"), F.first("keys").alias("keys"), F.count("*").alias("m"))
    # numbered while written, so that each set has one number from now on
    heads = stored(heads.select(F.monotonically_increasing_id().alias("node"), "head.*", "one", "two", F.col("n_shingles").alias("n"), "m", "keys"))
    nodes = heads.drop("keys")
    keyed = heads.select("node", F.explode("keys").alias("key"))
    buckets = stored(keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("m")).where("m > 1"))
    members = stored(join_counted(keyed, buckets, ["key"], "m").select("key", "node", "pivot"))
    first = stored(members.where("pivot <> node").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct())
    links = confirmed(docs, nodes, first, shingle, threshold)
    more = repeated_ids(found, nodes)
    links = links if more is None else stored(links.union(more))
    classes = components(links)
    opened = open_members(members.select("key", "node"), classes)
    if not opened.isEmpty():
        kept = prefixes(docs, nodes, opened, shingle, threshold)
        sized = opened.join(few(kept.select("node", "n", "common")), "node")
        middle = sized.groupBy("key").agg(F.max_by(F.struct("node", "n", "comp", "common"), F.struct("common", "node")).alias("a"), F.count("*").alias("m"))
        least = F.least("a.common", "common")
        near = F.lit(100) * least >= F.lit(threshold) * (F.col("a.n") + F.col("n") - least)
        pairs = join_counted(sized.drop("m"), stored(middle), ["key"], "m").where(near & (F.col("a.comp") != F.col("comp")))
        second = stored(pairs.select(F.least("a.node", "node").alias("a"), F.greatest("a.node", "node").alias("b")).distinct().join(first, ["a", "b"], "left_anti"))
        links = stored(links.union(confirmed(docs, nodes, second, shingle, threshold)))
        classes = components(links)
        opened = open_members(opened.select("key", "node"), classes)
        third = prefix_pairs(opened.select("node", "comp").distinct().join(kept, "node"), opened, threshold).join(first, ["a", "b"], "left_anti").join(second, ["a", "b"], "left_anti")
        classes = components(links.union(confirmed(docs, nodes, stored(third), shingle, threshold)))
    # a class bears its smallest id
    own = nodes.join(few(classes.select(F.col("node").alias("_n"), "comp")), F.col("node") == F.col("_n"), "left").select("one", "two", F.col("n").alias("n_shingles"), "id", "m", "comp")
    least = stored(own.where("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("smallest"), F.count("*").alias("c")))
    own = join_counted(own.where("comp IS NOT NULL"), least, ["comp"], "c").select("one", "two", "n_shingles", "m", "smallest").union(own.where("comp IS NULL").select("one", "two", "n_shingles", "m", "id"))
    skinny = found.select("id", "n_shingles", "one", "two")
    some = F.col("id").isNotNull() & F.col("one").isNotNull()
    out = join_counted(skinny.where(some), stored(own), ["one", "two", "n_shingles"], "m").select("id", "n_shingles", F.col("smallest").alias("component"))
    out = out.union(skinny.where(~some).select("id", "n_shingles", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"), (F.col("id").isNull() | (F.col("id") == F.col("component"))).alias("kept"))


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """docs less the documents that aren't kept; of rows that repeat a kept id, the one with the smallest text stays."""
    found = stored(near_duplicates(docs, id_col=id_col, text=text, **settings).select(id_col, "kept"))
    gone = found.where(~F.col("kept")).select(F.col(id_col).alias("_gone")).distinct()
    out = docs.join(few(gone), docs[id_col] == F.col("_gone"), "left_anti")
    again = stored(found.where(F.col("kept") & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_again")).agg(F.count("*").alias("_n")).where("_n > 1").select("_again"))
    if again.isEmpty():
        return out
    again, same = few(again), docs[id_col] == F.col("_again")
    columns = [f"`{c}`" for c in docs.columns]
    one = out.join(again, same, "left_semi").groupBy(F.col(id_col).alias("_id")).agg(F.min_by(F.struct(*columns), F.struct(text, F.xxhash64(*columns))).alias("_row")).select("_row.*")
    return out.join(again, same, "left_anti").unionByName(one)


def op4_near_duplicates(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, shingle=3, threshold=85, hashes=60)


OP4_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(0, len(w) - 2), lambda i: array_to_string(list_slice(w, i + 1, i + 3), ' ')) END) AS s FROM doc),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
multi AS (SELECT s FROM shingle GROUP BY s HAVING count(*) > 1),
inter AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM (SELECT * FROM shingle SEMI JOIN multi USING (s)) a JOIN (SELECT * FROM shingle SEMI JOIN multi USING (s)) b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM inter JOIN size x ON a = x.doc_id JOIN size y ON b = y.doc_id WHERE 100 * i >= 85 * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM doc UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
comp AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a)
SELECT doc.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, doc.doc_id = c AS kept
FROM doc LEFT JOIN size USING (doc_id) JOIN comp USING (doc_id)
"""
