"""Which keys were processed before, against a history much longer than the new rows.

``<root>/keys/<generation>/bucket=…`` holds the processed keys, ``<root>/filters/<generation>`` Bloom filters over them, and
``<root>/versions/<n>`` the generations that count, a line each. `pending` asks the filters first; only keys that may be in the history
meet it in an exact join, and only the buckets these keys fall into are read.

A filter is cut into blocks of `BLOCK_BITS` bits for about `BLOCK_KEYS` keys. A key belongs to one block of each generation, so the test is
an equi-join by generation and block. `record` takes up all generations that are not more than twice its own, so each one is more than
twice the next smaller one: there are as many as the history has binary digits, and a key is rewritten that often. Generations of fewer
than `SMALL_BLOCKS` blocks therefore make up two times that many in all, which bounds what is broadcast; the others have enough blocks to
spread a shuffle.

Keys are compared as strings. A null in a key matches nothing: such rows stay pending and are not recorded. Repeated keys count once, repeated
rows stay. A version appears once its marker does, so a reader sees whole generations, and a run whose marker was taken by
another one takes off what that one recorded and tries again. What a crashed run wrote is never read.
"""

from __future__ import annotations

import time
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendengine.operators.joins import spread_join
from trendengine.session import create_if_absent, remove_folder, scratch_path
from trendengine.sources.batches import folder_names

#: Part of the layout: other values need a new folder. 16 bits a key and 8 hashes let about one miss in 1,500 through.
BLOCK_BITS, BLOCK_KEYS, HASHES = 32768, 2048, 8  # bits: what one bitmap of Spark holds
BUCKET_KEYS, MOST_BUCKETS = 1_000_000, 4096
SMALL_BLOCKS = 1024
ATTEMPTS, PAUSE = 20, 0.2


class Generation(NamedTuple):
    folder: str
    keys: int
    blocks: int
    buckets: int


def generations(spark: SparkSession, root: str) -> tuple[int, list[Generation]]:
    """(newest version, its generations); version 0 has none. One short text."""
    version = max((int(n) for n in folder_names(spark, f"{root}/versions") if n.isdigit()), default=0)
    if not version:
        return 0, []
    lines = [r["value"].split() for r in spark.read.text(f"{root}/versions/{version}").collect()]
    return version, [Generation(name, *map(int, numbers)) for name, *numbers in lines]


def _place(keys: list[str]):
    return F.xxhash64(F.lit("place"), *keys)


def _bucket(keys: list[str], buckets):
    return F.pmod(F.shiftright(_place(keys), 32), F.lit(buckets)).cast("int")


def _block(keys: list[str], blocks):
    return F.pmod(_place(keys), blocks).cast("int")


def _first_and_step(keys: list[str]):
    """Where the bits of a key start in its block, and how far they are apart."""
    first = F.pmod(F.xxhash64(*keys), F.lit(BLOCK_BITS)).cast("int")
    step = F.pmod(F.xxhash64(F.lit("step"), *keys), F.lit(BLOCK_BITS)).cast("int").bitwiseOR(F.lit(1))
    return first, step


def _bit(i: int):
    return (F.col("_first") + F.col("_step") * i) % BLOCK_BITS


def _words(bits):
    """A block as longs of eight bytes each, the first one on top; made once a block, so that a test of a bit copies nothing."""
    at = F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1))
    return F.transform(at, lambda i: F.conv(F.hex(F.substring(bits, i * 8 + 1, F.lit(8))), 16, -10).cast("long"))


def _is_set(words, position):
    inside = position.bitwiseAND(63).bitwiseXOR(F.lit(56))  # bytes stand the other way round in a word
    return F.getbit(F.get(words, F.shiftright(position, 6)), inside) == 1


def _named(keys: list[str]) -> dict:
    """Key columns under the names that they have in the history, whatever the rows call them."""
    return {f"_key_{i}": F.col(f"`{k}`").cast("string") for i, k in enumerate(keys)}


def _keys_in(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of rows, without nulls."""
    return rows.select(*(column.alias(name) for name, column in _named(keys).items())).dropna()


def filter_blocks(rows: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """(block, bits) over distinct keys. Hashes are shuffled once, by block, and become bits behind the shuffle.

    Each hash makes a bitmap of its own from the rows as they are, then these are joined: what is sorted by block is keys, not bits.
    """
    first, step = _first_and_step(keys)
    hashed = rows.select(_block(keys, F.lit(blocks)).alias("block"), first.alias("_first"), step.alias("_step")).repartition("block")
    each = hashed.groupBy("block").agg(*(F.bitmap_construct_agg(_bit(i).cast("long")).alias(f"_{i}") for i in range(HASHES)))
    bits = each.select("block", F.explode(F.array(*(f"_{i}" for i in range(HASHES)))).alias("bits"))
    return bits.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _keys_of(spark: SparkSession, root: str, generation: Generation, keys: list[str]) -> DataFrame:
    schema = ", ".join(f"{k} string" for k in keys) + ", bucket int"
    return spark.read.schema(schema).parquet(f"{root}/keys/{generation.folder}")


def _numbered(values, kind: str):
    """The value of generation ``_g``."""
    return F.get(F.array(*map(F.lit, values)), F.col("_g")).cast(kind)


def possible_hits(spark: SparkSession, root: str, wanted: DataFrame, keys: list[str], found: list[Generation]) -> DataFrame:
    """(keys, generation, bucket): distinct keys and the generations whose filters let them through.

    What is asked need not be distinct: rows go to the blocks as they are, once, and only those let through are made distinct. The
    blocks are the hashed side of the join, BLOCK_BITS for BLOCK_KEYS keys, so the rows are not sorted.
    """
    first, step = _first_and_step(keys)
    hashed = wanted.select(*keys, first.alias("_first"), step.alias("_step"), _place(keys).alias("_place"))
    parts = []
    for small in (True, False):
        some = [g for g in found if (g.blocks < SMALL_BLOCKS) == small]
        if not some:
            continue
        asked = hashed.withColumn("_g", F.explode(F.array(*map(F.lit, range(len(some))))))
        block = F.pmod("_place", _numbered([g.blocks for g in some], "long")).cast("int")
        asked = asked.select(*keys, "_first", "_step", "_g", block.alias("_block"))
        filters = spark.read.schema("generation string, block int, bits binary").parquet(*(f"{root}/filters/{g.folder}" for g in some))
        number = F.array_position(F.array(*(F.lit(g.folder) for g in some)), F.col("generation")) - 1
        filters = filters.select(number.cast("int").alias("_g"), F.col("block").alias("_block"), _words(F.col("bits")).alias("words"))
        # fewer than 2 * SMALL_BLOCKS blocks of 4 KB and one a generation are sent
        a, f = asked.alias("a"), filters.hint("broadcast" if small else "shuffle_hash").alias("f")
        same = (F.col("a._g") == F.col("f._g")) & (F.col("a._block") == F.col("f._block"))
        for i in range(HASHES):
            same = same & _is_set(F.col("f.words"), _bit(i))
        bucket = F.pmod(F.shiftright(_place(keys), 32), _numbered([g.buckets for g in some], "long")).cast("int")
        parts.append(a.join(f, same, "left_semi").select(*keys, _numbered([g.folder for g in some], "string").alias("generation"), bucket.alias("bucket")))
    hits = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return hits.distinct()


def pending(spark: SparkSession, root: str, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not in the history. The hits are written to the shared folder; where there are none, no key is read."""
    _, found = generations(spark, root)
    if not found:
        return rows
    path, named = scratch_path(spark, "hits"), _named(keys)
    names = list(named)
    possible_hits(spark, root, _keys_in(rows, keys), names, found).write.parquet(path)
    hits = spark.read.parquet(path)
    touched = hits.groupBy("generation").agg(F.collect_set("bucket").alias("buckets")).collect()  # MOST_BUCKETS a generation at most
    if not touched:
        remove_folder(spark, path)
        return rows
    stored, known = {g.folder: g for g in found}, None
    for r in touched:
        part = _keys_of(spark, root, stored[r["generation"]], names).where(F.col("bucket").isin(r["buckets"]))
        part = part.select(*names, F.lit(r["generation"]).alias("generation"))
        known = part if known is None else known.unionByName(part)
    known = known.join(hits.select(*names, "generation"), [*names, "generation"], "left_semi").select(*names).distinct()
    known.write.parquet(f"{path}-known")  # so that Spark knows its size, and the history is read once
    known = spark.read.schema(known.schema).parquet(f"{path}-known")
    return spread_join(rows.withColumns(named), known, names, "left_anti").select(*(f"`{c}`" for c in rows.columns))


def record(spark: SparkSession, root: str, rows: DataFrame, keys: list[str], before_publish=lambda: None) -> int:
    """Take the keys of processed rows into the history; how many were new.

    ``before_publish`` is called when an attempt is written, before its marker is.
    """
    staged, names = scratch_path(spark, "processed"), list(_named(keys))
    _keys_in(rows, keys).distinct().write.parquet(staged)
    batch = spark.read.parquet(staged)
    for attempt in range(1, ATTEMPTS + 1):
        version, found = generations(spark, root)
        path = scratch_path(spark, "new-keys")
        pending(spark, root, batch, names).write.parquet(path)
        fresh = spark.read.parquet(path)
        new = n = fresh.count()
        if not n:
            remove_folder(spark, path)
            remove_folder(spark, staged)
            return 0
        kept = sorted(found, key=lambda g: g.keys)
        while kept and kept[0].keys <= 2 * n:
            n += kept[0].keys
            fresh = fresh.unionByName(_keys_of(spark, root, kept.pop(0), names).select(*names))
        made = Generation(f"{version + 1:09}-{uuid.uuid4().hex}", n, -(-n // BLOCK_KEYS), min(MOST_BUCKETS, -(-n // BUCKET_KEYS)))
        fresh.withColumn("bucket", _bucket(names, made.buckets)).repartition("bucket").write.partitionBy("bucket").parquet(f"{root}/keys/{made.folder}")
        blocks = filter_blocks(_keys_of(spark, root, made, names), names, made.blocks)
        blocks.select(F.lit(made.folder).alias("generation"), "block", "bits").write.parquet(f"{root}/filters/{made.folder}")
        before_publish()
        text = "\n".join(" ".join(map(str, g)) for g in [*kept, made])
        won = create_if_absent(spark, f"{root}/versions/{version + 1}", text)
        remove_folder(spark, path)
        if won:
            remove_folder(spark, staged)
            return new
        for kind in ("keys", "filters"):
            remove_folder(spark, f"{root}/{kind}/{made.folder}")
        time.sleep(PAUSE * attempt)
    raise RuntimeError(f"{root}: others recorded {ATTEMPTS} times in a row")


def expire(spark: SparkSession, root: str) -> list[str]:
    """Remove the generations that the newest version does not name. Only while no run reads or records."""
    _, found = generations(spark, root)
    live = {g.folder for g in found}
    old = sorted({*folder_names(spark, f"{root}/keys"), *folder_names(spark, f"{root}/filters")} - live)
    for name in old:
        for kind in ("keys", "filters"):
            remove_folder(spark, f"{root}/{kind}/{name}")
    return old


def unprocessed_artists(spark: SparkSession, root: str, artists: DataFrame) -> DataFrame:
    """Artists with a name that is not recorded yet; case and outer spaces do not count."""
    named = artist_names(artists).where(F.col("_name") != "")
    return pending(spark, root, named, ["_name"]).select(*artists.columns)


def artist_names(artists: DataFrame) -> DataFrame:
    """Rows with ``_name``, the key of `unprocessed_artists`."""
    return artists.withColumn("_name", F.lower(F.trim("artist")))
