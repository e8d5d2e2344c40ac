"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A topology is a tree of regions, racks and shards. A row descends it: at each level every
child makes a draw -ln(u) / weight, with u in (0, 1) hashed from the row's key and the
child's path, and the smallest draw wins. A child's weight is the sum of its shards'
weights, so each shard receives rows in proportion to its weight. A draw does not depend
on its siblings: where no weight below a node changes, no row moves among its children,
and a row only enters a child that gained weight or leaves one that lost some.

`Topology.grown` adds one shard as a region of its own. All old weights stay, hence rows
move into the new shard only, whatever the number of shards before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusmill.llm.common import stash, table

ROWS_PER_BUCKET = 20_000


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


@dataclass(frozen=True)
class Topology:
    leaves: tuple[Leaf, ...]

    @staticmethod
    def even(shards: int, racks_a_region: int = 2, shards_a_rack: int = 2) -> Topology:
        """Shards 0 .. shards-1 of weight 1, filled rack by rack and region by region."""
        rack = [i // shards_a_rack for i in range(shards)]
        return Topology(tuple(Leaf(f"r{k // racks_a_region}", f"k{k % racks_a_region}", i) for i, k in enumerate(rack)))

    def grown(self, weight: float = 1.0) -> Topology:
        """One more shard, in a new region with a rack of its own."""
        n = 1 + max((x.shard for x in self.leaves), default=-1)
        return Topology((*self.leaves, Leaf(f"x{n}", "k0", n, weight)))


def uniform(key: Column, path: str) -> Column:
    """A number in (0, 1) from the key's text and a path; 52 bits of MD5."""
    digits = F.substring(F.md5(F.concat_ws("/", key, F.lit(path))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def _draw(key: Column, weights: dict[str, float], path: str) -> Column:
    """The child with the smallest draw; ties go to the lower name."""
    options = [
        F.struct((-F.log(uniform(key, f"{path}{name}")) / F.lit(float(w))).alias("draw"), F.lit(name).alias("child"))
        for name, w in weights.items()
        if w > 0
    ]
    return options[0]["child"] if len(options) == 1 else F.array_min(F.array(*options))["child"]


def _branch(on: Column, arms: dict[str, Column]) -> Column:
    out = None
    for name, value in arms.items():
        out = F.when(on == name, value) if out is None else out.when(on == name, value)
    return out


def descend(df: DataFrame, key: Column, topology: Topology, out: str) -> DataFrame:
    """Add column `out` with each row's shard. A null key is hashed as no text at all."""
    tree: dict[str, dict[str, dict[str, float]]] = {}
    for x in topology.leaves:
        tree.setdefault(x.region, {}).setdefault(x.rack, {})[str(x.shard)] = x.weight
    key = F.coalesce(key.cast("string"), F.lit(""))
    r, k = f"__{out}_region", f"__{out}_rack"
    weight = lambda racks: sum(sum(v.values()) for v in racks.values())
    df = df.withColumn(r, _draw(key, {n: weight(racks) for n, racks in tree.items()}, "region/"))
    racks = {n: _draw(key, {m: sum(v.values()) for m, v in x.items()}, f"rack/{n}/") for n, x in tree.items()}
    df = df.withColumn(k, _branch(F.col(r), racks))
    shards = {
        n: _branch(F.col(k), {m: _draw(key, v, f"shard/{n}/{m}/") for m, v in x.items()}) for n, x in tree.items()
    }
    return df.withColumn(out, _branch(F.col(r), shards).cast("int")).drop(r, k)


def spot(*columns: Column) -> Column:
    """A row's place in a shuffled order: the MD5 of some columns, as text."""
    return F.md5(F.concat_ws("/", *(c.cast("string") for c in columns)))


def slots(df: DataFrame, group: Sequence[str], order: Sequence[str], rows: int, out: str = "slot") -> DataFrame:
    """Number the rows of each group from 0 without gaps, in many tasks, in the order of `order`.

    The first column of `order` is a `spot`. Its leading digits deal the rows into buckets, so
    that buckets follow the order; a window numbers each bucket, and a small table with a row
    for each bucket gives the number of rows in the buckets before it.
    """
    n = max(1, -(-rows // ROWS_PER_BUCKET))
    lead = F.conv(F.substring(order[0], 1, 8), 16, 10).cast("double") / float(1 << 32)
    df = df.withColumn("__bucket", F.floor(lead * n))
    keys = [*group, "__bucket"]
    before = W.partitionBy(*group).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(*keys, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    )
    ranked = df.withColumn("__rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return (
        ranked.join(starts, keys)
        .withColumn(out, (F.col("__start") + F.col("__rank") - 1).cast("long"))
        .drop("__start", "__rank", "__bucket")
    )


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Every document's shard, slot and shard after growth by one (law `key`).

    Nulls: a null text has size 1 and the CRC of no bytes; rows with a null doc_id share
    a key and hence a shard, with slots of their own. Repeated rows get different slots.
    Slots follow the MD5 of doc_id, CRC and size. An empty table gives no rows; other columns
    of the input are neither read nor returned.
    """
    topology = Topology.even(shards)
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = descend(rows, F.col("doc_id"), topology, "shard")
    rows = descend(rows, F.col("doc_id"), topology.grown(), "grown_shard")
    # Texts are read once and keys hashed once; what follows needs these few columns only.
    rows = stash(rows.withColumn("__spot", spot(F.col("doc_id"), F.col("text_crc32"), F.col("size"))), "shards")
    rows = slots(rows, ["shard"], ["__spot", "doc_id"], rows.count())
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH k AS (SELECT doc_id, text, coalesce(doc_id::VARCHAR, '') AS key FROM documents),
child(path, region, rack, shard, weight) AS (VALUES
  ('region/r0', 'r0', NULL, NULL, 4), ('region/r1', 'r1', NULL, NULL, 4), ('region/x8', 'x8', NULL, NULL, 1),
  ('rack/r0/k0', 'r0', 'k0', NULL, 2), ('rack/r0/k1', 'r0', 'k1', NULL, 2), ('rack/r1/k0', 'r1', 'k0', NULL, 2), ('rack/r1/k1', 'r1', 'k1', NULL, 2),
  ('shard/r0/k0/0', 'r0', 'k0', 0, 1), ('shard/r0/k0/1', 'r0', 'k0', 1, 1), ('shard/r0/k1/2', 'r0', 'k1', 2, 1), ('shard/r0/k1/3', 'r0', 'k1', 3, 1),
  ('shard/r1/k0/4', 'r1', 'k0', 4, 1), ('shard/r1/k0/5', 'r1', 'k0', 5, 1), ('shard/r1/k1/6', 'r1', 'k1', 6, 1), ('shard/r1/k1/7', 'r1', 'k1', 7, 1)),
draw AS (SELECT key, region, rack, shard,
           -ln((('0x' || substring(md5(key || '/' || path), 1, 13))::BIGINT + 0.5) / 4503599627370496) / weight AS draw
         FROM (SELECT DISTINCT key FROM k), child),
old AS (SELECT key, arg_min(region, draw) AS region FROM draw WHERE rack IS NULL AND region <> 'x8' GROUP BY key),
grown AS (SELECT key, arg_min(region, draw) AS region FROM draw WHERE rack IS NULL GROUP BY key),
rack AS (SELECT key, region, arg_min(rack, draw) AS rack FROM draw WHERE rack IS NOT NULL AND shard IS NULL GROUP BY 1, 2),
leaf AS (SELECT d.key, d.region, arg_min(d.shard, draw) AS shard FROM draw d JOIN rack r ON r.key = d.key AND r.region = d.region AND r.rack = d.rack
         WHERE d.shard IS NOT NULL GROUP BY 1, 2),
placed AS (SELECT old.key, a.shard, coalesce(b.shard, 8) AS grown_shard FROM old JOIN leaf a ON a.key = old.key AND a.region = old.region
           JOIN grown ON grown.key = old.key LEFT JOIN leaf b ON b.key = grown.key AND b.region = grown.region),
-- CRC-32 byte by byte, with its usual table of 256 steps.
step AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n)) AS steps),
crc AS (SELECT doc_id, key, (strlen(coalesce(text, '')) + 1)::BIGINT AS size,
          xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
                                      lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) AS text_crc32
        FROM k, step)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws('/', doc_id::VARCHAR, text_crc32::VARCHAR, size::VARCHAR)), doc_id) - 1 AS slot, grown_shard
FROM crc JOIN placed USING (key)
"""
