"""The trie of conversation beginnings, by truncation peeling.

Every turn is known by a hash of role and text, every beginning by the hash of its last turn and the beginning before
it. Conversations start at their full depth. From the greatest depth upwards, the conversations that end at a depth join
the nodes that are left there, their last turns are stripped, and what then has the same key is regrouped into the node
above: members, smallest member, children, leaves and saved bytes add up while the nodes are found, so every turn
is looked at once.

The depth at which beginnings are shared by more than `most` turns of different conversations is found first. Below
it, each beginning's conversations are peeled inside one task, level after level; from there to the root every level is
one regrouping in Spark with partial sums, which no frequent beginning burdens. Conversations of the same turns are one
row from the start. The ids that end at a node are written out in sorted pieces by many tasks; only their digest, which
is sequential by nature, is made from these pieces in one.

Defined cases: turns are ordered by turn, null first, equal turns by the hash of role and text; null roles and texts
are empty; rows with a null conversation id are left out; rows that repeat count as turns of their own; an empty
table gives no node; other columns are ignored. A conversation's turns are held together in one task, as bare hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import join_counted, stored

#: Turns of different conversations with one beginning that one task peels, and ids written in one piece.
MOST, PIECE = 200_000, 5_000
ROOT = b""
NONE = hashlib.sha256(b"").hexdigest()


def turns_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): structs (turn, mark, bytes) in order, for each conversation of rows (conv_id, turn, role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    marked = rows.where("conv_id IS NOT NULL").select("conv_id", F.struct("turn", mark.alias("mark"), F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    return marked.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(own: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """(conv_id, turns): the first h turns of conversation c - c % group, then the own ones after the first h; h = crc32(c) % heads."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("int")
    first = own.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, heads - 1).alias("_first"))
    both = own.withColumn("_h", h).join(first, F.col("conv_id") - F.col("conv_id") % group == F.col("_base"), "left")
    begun = F.when(F.col("_h") > 0, F.slice(F.coalesce("_first", F.slice("turns", 1, 0)), F.lit(1), F.col("_h"))).otherwise(F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    return both.select("conv_id", F.concat(begun, rest).alias("turns"))


def chained(convs: DataFrame) -> DataFrame:
    """(conv_id, keys, bytes, key, depth): keys of all beginnings but the root; key: the whole conversation's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, last, depth = [], [], []
            for marks in batch.column(1).to_pylist():
                own, key = [], ROOT
                for mark in marks:
                    key = hashlib.blake2b(key + mark, digest_size=16).digest()
                    own.append(key)
                keys.append(own)
                last.append(key)
                depth.append(len(own))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.binary())), batch.column(2), pa.array(last, pa.binary()), pa.array(depth, pa.int32())], names=["conv_id", "keys", "bytes", "key", "depth"])

    kind = convs.schema["conv_id"].dataType.simpleString()
    return convs.select("conv_id", F.transform("turns", lambda t: t["mark"]).alias("marks"), F.transform("turns", lambda t: t["bytes"]).alias("bytes")).mapInArrow(run, f"conv_id {kind}, keys array<binary>, bytes array<long>, key binary, depth int")


def ends(convs: DataFrame) -> DataFrame:
    """(key, ends_sha256) for every key at which conversations end: the digest of their ids in order, joined by commas."""

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids = None, []

        def piece(key, ids):
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], names=["key", "at", "piece"])

        for batch in batches:
            for key, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (key != at or len(ids) == PIECE):
                    yield piece(at, ids)
                    ids = []
                at = key
                ids.append(own)
        if ids:
            yield piece(at, ids)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is not None and key == at:
                    state.update(b",")
                else:
                    if state is not None:
                        out.append((at, state.hexdigest()))
                    at, state = key, hashlib.sha256()
                state.update(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], names=["key", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    rows = convs.select("key", F.col("conv_id").cast("long").alias("conv_id"))
    pieces = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(written, "key binary, at long, piece string")
    return pieces.repartition("key").sortWithinPartitions("key", "at").select("key", "piece").mapInArrow(digested, "key binary, ends_sha256 string")


def cut(whole: DataFrame, most: int) -> int:
    """The least of the depths 0, 1, 2, 4, 8 ... below which no beginning has over `most` turns of different conversations."""
    deepest = whole.agg(F.max("depth")).first()[0] or 0
    depths = [0, *(2**k for k in range(deepest.bit_length()))]
    tried = F.explode(F.filter(F.array(*map(F.lit, depths)), lambda d: d < F.col("depth")))
    sizes = whole.select("keys", "depth", tried.alias("d"))
    sizes = sizes.groupBy("d", F.when(F.col("d") > 0, F.expr("keys[d - 1]")).alias("k")).agg(F.sum(F.col("depth") - F.col("d")).alias("turns"))
    large = sizes.where(F.col("turns") > most).agg(F.max("d")).first()[0]
    return 0 if large is None else next((d for d in depths if d > large), deepest)


NODE = "key binary, parent binary, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, keys array<binary>, bytes array<long>"


def peeled(whole: DataFrame, depth: int) -> DataFrame:
    """All nodes below the given depth, each beginning of that depth inside one task."""

    def levels(rows: list[dict]) -> Iterator[tuple]:
        at: dict[int, list[dict]] = {}
        for r in rows:
            at.setdefault(r["depth"], []).append(r)
        alive: dict[bytes, list] = {}  # key -> representative, smallest id, members, children, leaves, saved
        for d in range(max(at), depth, -1):
            for r in at.get(d, []):  # conversations that end here
                node = alive.setdefault(r["keys"][d - 1], [r, r["conv_id"], 0, 0, 0, 0])
                node[1], node[2] = min(node[1], r["conv_id"]), node[2] + r["n_convs"]
            above: dict[bytes, list] = {}
            for key, (r, least, n, children, leaves, saved) in alive.items():
                leaves, saved = leaves or 1, saved + (n - 1) * r["bytes"][d - 1]
                parent = r["keys"][d - 2] if d > 1 else ROOT
                # only the nodes that Spark regroups need what stands above them
                path = (r["keys"][:d], r["bytes"][:d]) if d == depth + 1 else (None, None)
                yield key, parent, d, least, n, children, leaves, saved, *path
                node = above.setdefault(parent, [r, least, 0, 0, 0, 0])
                node[1:] = [min(node[1], least), node[2] + n, node[3] + 1, node[4] + leaves, node[5] + saved]
            alive = above

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in NODE.split(", ")]
        kinds = [pa.binary(), pa.binary(), pa.int32(), *[pa.int64()] * 5, pa.list_(pa.binary()), pa.list_(pa.int64())]

        def out(rows):
            found = list(levels(rows))
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], kind) for k, kind in enumerate(kinds)], names=names)

        group, rows = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if rows and r["g"] != group:
                    yield out(rows)
                    rows = []
                group = r["g"]
                rows.append(r)
        if rows:
            yield out(rows)

    group = F.expr(f"keys[{depth - 1}]") if depth else F.lit(ROOT)
    deep = whole.where(F.col("depth") > depth).select(group.alias("g"), "depth", F.col("conv_id").cast("long").alias("conv_id"), "n_convs", "keys", "bytes")
    return deep.repartition("g").sortWithinPartitions("g").mapInArrow(run, NODE)


def trie(convs: DataFrame, *, most: int = MOST) -> DataFrame:
    """One row per node of the beginnings of conversations (conv_id, turns); see turns_of.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).
    """
    found = stored(chained(convs))
    whole = stored(found.groupBy("key", "depth").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("keys").alias("keys"), F.first("bytes").alias("bytes")))
    if whole.isEmpty():
        kind = convs.schema["conv_id"].dataType.simpleString()
        return convs.sparkSession.createDataFrame([], f"conv_id {kind}, depth long, parent_conv_id {kind}, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    depth = cut(whole, most)
    below = stored(peeled(whole, depth))
    levels, last = [below.drop("keys", "bytes")], below.where(F.col("depth") == depth + 1)
    for d in range(depth, -1, -1):
        up = last.select(F.col("parent").alias("key"), "conv_id", "n_convs", F.lit(1).cast("long").alias("child"), "n_leaves", "saved_tokens", F.slice("keys", 1, d).alias("keys"), F.slice("bytes", 1, d).alias("bytes"))
        own = whole.where(F.col("depth") == d).select("key", F.col("conv_id").cast("long").alias("conv_id"), "n_convs", *(F.lit(0).cast("long").alias(c) for c in ("child", "n_leaves", "saved_tokens")), "keys", "bytes")
        level = up.unionByName(own).groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("child").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"), F.first("keys").alias("keys"), F.first("bytes").alias("bytes"))
        parent = F.lit(None).cast("binary") if d == 0 else F.lit(ROOT) if d == 1 else F.expr(f"keys[{d - 2}]")
        own_bytes = F.expr(f"bytes[{d - 1}]") if d else F.lit(0)
        saved = F.col("saved") + (F.col("n_convs") - 1) * own_bytes
        last = stored(level.select("key", parent.alias("parent"), F.lit(d).alias("depth"), "conv_id", "n_convs", "n_children", F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), saved.alias("saved_tokens"), "keys", "bytes"))
        levels.append(last.drop("keys", "bytes"))
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    parents = nodes.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_n"))
    linked = join_counted(nodes.where("parent IS NOT NULL"), stored(parents), ["parent"], "_n").drop("_n")
    linked = linked.unionByName(nodes.where("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long")))
    out = linked.join(ends(found), "key", "left")
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256"))


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(rebuilt(turns_of(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


OP13_SQL = r"""
WITH own AS MATERIALIZED (SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS w FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)), lambda x, _: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)))) % 9 AS h FROM own),
conv AS MATERIALIZED (
  SELECT c.conv_id, list_concat(CASE WHEN h = 0 OR b.w IS NULL THEN [] ELSE b.w[1:h] END, CASE WHEN h >= len(c.w) THEN [] ELSE c.w[h + 1:] END) AS w
  FROM headed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
node AS MATERIALIZED (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, list(conv_id ORDER BY conv_id) FILTER (WHERE len(w) = d) AS e
  FROM (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS d, CASE WHEN d = 0 THEN [] ELSE w[1:d] END AS p FROM conv) GROUP BY p, d),
child AS (SELECT n.p, n.d, count(*) AS n FROM node n JOIN node c ON c.d = n.d + 1 AND n.p = (CASE WHEN n.d = 0 THEN [] ELSE c.p[1:n.d] END) GROUP BY n.p, n.d),
full_node AS MATERIALIZED (SELECT node.*, coalesce(n, 0) AS n_children, (n_convs - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(p[d].t) END AS s FROM node LEFT JOIN child USING (p, d)),
tree AS (
  SELECT q AS p, g AS d, sum((n_children = 0)::INT) AS n_leaves, sum(s) AS saved
  FROM (SELECT n_children, s, unnest(range(0, f.d + 1)) AS g, CASE WHEN g = 0 THEN [] ELSE f.p[1:g] END AS q FROM full_node f) GROUP BY q, g)
SELECT f.conv_id, f.d AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(array_to_string(f.e, ','), '')) AS ends_sha256
FROM full_node f JOIN tree USING (p, d) LEFT JOIN node u ON u.d = f.d - 1 AND u.p = (CASE WHEN f.d = 1 THEN [] ELSE f.p[1:f.d - 1] END)
"""
