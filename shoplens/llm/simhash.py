"""SimHash near-duplicates, with candidates found by Golay-code fuzzy hashing.

A fingerprint holds, for each of 64 bits, the majority among the hashes of the text's shingles.
To find fingerprints that differ in at most two bits, each is cut into three segments. Two errors
leave one segment whole, and the next one has at most two errors, so both fingerprints decode it to
a common Golay codeword. A fingerprint is therefore filed under (whole segment, codeword of the
next), which is 1 or 6 keys for each segment, and only fingerprints that share a key are compared.

Copies are one fingerprint with many documents, so a group of copies is one row. In a key with up to
``PAIRWISE`` fingerprints all pairs are compared. Fingerprints of a larger key are linked by way of their
neighbours instead: two of them differ in at most two bits just when some value is within one bit of
both, so each is filed under itself and its 64 one-bit changes, and linked to the smallest fingerprint
there. That is exact too, and takes 65 rows for a fingerprint however many share the key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm import golay
from shoplens.llm.components import stars
from shoplens.llm.tables import parts, pick
from shoplens.scratch import materialize

SHINGLE, SEED = 3, 42
#: Bits of the three segments.
SEGMENTS = (22, 21, 21)
#: Fingerprints that share a key and are compared pair by pair.
PAIRWISE = 64
#: Hashes whose bits are counted at a time.
CHUNK = 1 << 14


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits of a whole text; 0 for a text without words."""
    words = (text or "").encode().lower().split()  # of bytes: ASCII letters, ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, CHUNK):
        part = hashes[i : i + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fp (a signed long with the 64 bits) of every row. A null text is an empty one."""

    rows = pick(docs, key=key, text=text)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            fps = np.array([fingerprint(x) for x in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(fps.view(np.int64))], ["key", "fp"])

    return rows.mapInArrow(marked, f"key {rows.schema['key'].dataType.simpleString()}, fp long")


def _filed(batches):
    """Arrow batches of fp -> key, fp."""
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False)
        bits = fps.view(np.uint64)
        starts = np.cumsum((0, *SEGMENTS[:-1]))
        parts = [((bits >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in zip(starts, SEGMENTS)]
        for i, whole in enumerate(parts):
            words, count = golay.indices(parts[(i + 1) % len(parts)])
            keys = (np.int64(i) << 40) | (whole[:, None] << 12) | words
            used = np.arange(words.shape[1]) < count[:, None]
            yield pa.RecordBatch.from_arrays([pa.array(keys[used]), pa.array(np.repeat(fps, count))], ["key", "fp"])


def links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) -> (a, b), pairs within two bits whose components are those of all such pairs."""
    filed = materialize(fps.select("fp").mapInArrow(_filed, "key long, fp long"), "golay-keys")
    sizes = filed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = filed.join(sizes, "key")
    # Bounded groups: every pair, but only those within two bits leave the group.
    near = F.expr(
        "flatten(transform(fps, a -> transform(filter(fps, b -> a < b AND bit_count(a ^ b) <= 2), b -> struct(a, b))))"
    )
    pairs = shared.where(f"n <= {PAIRWISE}").groupBy("key").agg(F.collect_list("fp").alias("fps")).select(F.explode(near).alias("p"))
    # Large groups, by neighbours. What shares a smaller key as well is found twice, which does no harm.
    crowded = materialize(shared.where(f"n > {PAIRWISE}").select("fp").distinct(), "crowded")
    flips = [F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")) for i in range(64))]
    around = crowded.select("fp", F.explode(F.array(*flips)).alias("at"))
    lowest = around.groupBy("at").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select("at", "lo")
    near_low = around.join(lowest, "at").where("fp <> lo").select(F.col("fp").alias("a"), F.col("lo").alias("b"))
    return pairs.select("p.a", "p.b").unionByName(near_low).distinct()


def components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fp and component (the smallest key that links reach) of every row.

    Null and empty texts have fingerprint 0 and are linked like any other. Rows without key take part, but
    a component's id is its smallest key that is not null (null if there is none). Repeated rows stay
    repeated. An empty table gives no rows.
    """
    marked = materialize(fingerprints(docs, key, text), "fingerprints")
    return marked.join(_classes(marked), "fp").select("key", "fp", "component")


def _classes(marked: DataFrame) -> DataFrame:
    """key, fp of rows -> fp, root (a fingerprint that names the component), component of each fingerprint, stored."""
    fps = marked.groupBy("fp").agg(F.min("key").alias("least"))
    star = stars(links(fps))
    roots = star.select("node", "root").unionByName(star.select(F.col("root").alias("node"), "root").distinct())
    linked = roots.join(fps, F.col("node") == F.col("fp")).select("node", "root", "least")
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    named = linked.join(least, "root").select("node", "root", "component")
    # Stored, so that both sides of a join are plain shuffles and Spark may split a fingerprint with many rows.
    return materialize(
        fps.join(named, F.col("fp") == F.col("node"), "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("node").isNull(), F.col("least")).otherwise(F.col("component")).alias("component")
        ),
        "classes",
    )


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of its smallest key and, where several texts have this key, of the least fingerprint.

    A key that rows of different texts share stands for each of them: what is no copy of a kept row stays. Rows
    without key stay, once for each text, also beside rows with a key. Rows that repeat key and text stay once. Very long and empty
    texts are like any other. An empty table stays empty.
    """
    marked = materialize(fingerprints(docs, key, text), "fingerprints")
    placed = marked.where("key IS NOT NULL").groupBy("key", "fp").agg(F.count("*").alias("n")).join(_classes(marked).select("fp", "root"), "fp")
    kept = placed.groupBy("root").agg(F.min(F.struct("key", "fp")).alias("k")).select("k.key", "k.fp")
    several = placed.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("key")
    kept = materialize(kept.join(several.withColumn("several", F.lit(True)), "key", "left"), "kept")
    one, more = (materialize(kept.where(c).select(F.col("key").alias("kept"), F.col("fp").alias("kept_fp")), label) for c, label in (("several IS NULL", "kept-keys"), ("several", "kept-texts")))
    rows = docs.toDF(*(f"_{i}" for i in range(len(docs.columns))))
    key_, text_ = (f"_{docs.columns.index(name)}" for name in (key, text))
    found = rows.join(one, F.col(key_) == F.col("kept"), "left_semi").dropDuplicates([key_])
    # Of keys with several texts the fingerprint decides; they are few, and only their texts are read again.
    doubtful = rows.join(more.select("kept").distinct(), F.col(key_) == F.col("kept"), "left_semi").withColumn("fp", _fingerprint_of(F.col(text_)))
    chosen = doubtful.join(more, (F.col(key_) == F.col("kept")) & (F.col("fp") == F.col("kept_fp")), "left_semi").dropDuplicates([key_, "fp"]).drop("fp")
    nameless = rows.where(F.col(key_).isNull()).dropDuplicates([text_])
    return found.unionByName(chosen).unionByName(nameless).toDF(*docs.columns)


def _fingerprint_of(text: Column) -> Column:
    @F.pandas_udf("long")
    def marked(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x) for x in texts], dtype=np.uint64).view(np.int64))

    return marked(text)
