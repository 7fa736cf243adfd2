"""Near-duplicates by Jaccard similarity of shingle sets, found with SetSketch registers.

Each shingle starts a Poisson process of points, each dealt to one of the registers, and a register keeps
the least point it is dealt by any shingle of the set, truncated to a power of ``BASE`` (Ertl, "SetSketch:
filling the gap between MinHash and HyperLogLog"). Minima of parts merge by the larger register, and the share
of equal registers follows the similarity. Points come in rising order, so a shingle is done as soon as
its next point is above all registers, and a set costs about m log m points however large it is.

Equal sets are one row with members. Sets are filed under bands of registers, and those that share a bucket
are candidates. First all sets of a bucket are held against one, that which meets most others in all its
buckets. It lies amid them, so a group of near copies is mostly one component then, whatever its size. After that only
buckets whose sets are in several components are looked at again. Where few sets lie beside the largest
component, they are held against the whole bucket, and pairs whose register bits allow it are candidates. Any
other bucket is compared block by block, together with those it shares sets with: bounded groups of sets meet in one task,
which gives out nothing but similar pairs. That takes time with the square of such a cluster, which holds sets close below the
asked similarity; nothing is left out. Candidates whose registers, together with the sizes of the sets, make the asked
similarity too unlikely are dropped, and the others are confirmed on the full sets.

Two sets at exactly 0.8 share no band at all with a chance of 3 in a million, at 0.85 of one in 10^9; the two
bounds on candidates lose less than that. Whatever is linked is linked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.components import stars
from shoplens.llm.tables import parts, pick
from shoplens.scratch import materialize

SHINGLE, SEED = 2, 42
#: Links need 100 * intersection >= SIMILAR * union.
SIMILAR = 80
BANDS, ROWS = 42, 6
REGISTERS = BANDS * ROWS
#: Registers hold 1 - log_BASE(RATE-scaled point), from 0 to TOP; fixed values of the published parameters for two bytes.
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
#: Sets beside a bucket's largest component that are held against the whole bucket by a join.
FEW = 16
#: Sets of a block of a cluster of larger buckets.
BLOCK = 256
#: Register bits by which two sets at the asked similarity may differ: 25 of 252 are expected, 58 is seven deviations more.
BITS_APART = 58
#: Log-likelihood that the asked similarity may fall short of the best one.
MARGIN = 20.0

#: Bits of the bitmap that filters rows before they are shuffled: at most 2^18 rows of it, whatever the number of sets.
FILTER_BITS = 1 << 24

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(z: np.ndarray) -> np.ndarray:
    """The finisher of SplitMix64, for arrays of 64-bit integers."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a whole text's shingles; none for a text without words."""
    words = (text or "").encode().lower().split()  # of bytes: ASCII letters, ASCII white space
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=len(shingles)))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The registers of a set of at least one element."""
    least = np.full(REGISTERS, np.inf)
    active, last, step = hashes, np.zeros(len(hashes)), 0
    while len(active):
        points = max(1, 8 * REGISTERS // len(active))
        counter = np.arange(2 * step, 2 * (step + points), dtype=np.uint64) * _GOLDEN
        drawn = _mix(active[:, None] + counter)
        gaps = -np.log1p(-(drawn[:, ::2] >> np.uint64(11)).astype(np.float64) * 2.0**-53)
        gaps[:, 0] += last
        at = np.cumsum(gaps, axis=1)  # one addition after the other: the same points however they are dealt to rounds
        np.minimum.at(least, (drawn[:, 1::2] % np.uint64(REGISTERS)).astype(np.intp).ravel(), at.ravel())
        going = at[:, -1] < least.max()
        active, last, step = active[going], at[going, -1], step + points
    # A gap has mean 1, so a register's points have rate 1 / REGISTERS.
    scaled = 1 - np.log(least / (REGISTERS * RATE)) / np.log(BASE)
    return np.clip(np.floor(scaled), 0, TOP).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def _likelihood(above, below, same, u, v, j):
    """Log-likelihood of similarity j, for sets of shares u and v of both sizes' sum and the counts of registers."""

    def p(x):
        return np.clip(-np.log1p(-np.clip(x, 0, None) * (BASE - 1) / BASE) / np.log(BASE), 1e-300, 1.0)

    more, less = p(u - v * j), p(v - u * j)
    return above * np.log(more) + below * np.log(less) + same * np.log(np.clip(1 - more - less, 1e-300, 1.0))


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Likeliest similarity of pairs (rows of registers and sizes of the sets), and by how much the asked one is less likely."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - above - below
    u = n_a / (n_a + n_b)
    v = 1 - u
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(50):  # the function has one maximum: thirds
        left, right = low + (high - low) / 3, high - (high - low) / 3
        rising = _likelihood(above, below, same, u, v, left) < _likelihood(above, below, same, u, v, right)
        low, high = np.where(rising, left, low), np.where(rising, high, right)
    best = (low + high) / 2
    asked = np.minimum(np.maximum(best, SIMILAR / 100), np.maximum(np.minimum(u / v, v / u), SIMILAR / 100))
    return best, _likelihood(above, below, same, u, v, best) - _likelihood(above, below, same, u, v, asked)


def _digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set, as two signed longs."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), dtype="<i8").tolist())


def sketched(given: DataFrame) -> DataFrame:
    """key, text -> every row, stored: row (a number of its own), key, said (hash of the text), n (size of its set), d1 and d2 (its digest), registers."""
    given = given.withColumns({"row": F.monotonically_increasing_id(), "said": F.xxhash64("text")})
    kind = given.schema["key"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            sets = [shingle_hashes(x) for x in batch.column("text").to_pylist()]
            digests = np.array([_digest(x) for x in sets], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(x) for x in ("row", "key", "said")), pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy()),
                    pa.array([registers(x).tobytes() if len(x) else None for x in sets], pa.binary()),
                ],
                ["row", "key", "said", "n", "d1", "d2", "registers"],
            )

    schema = f"row long, key {kind}, said long, n long, d1 long, d2 long, registers binary"
    return materialize(given.mapInArrow(made, schema), "set-sketches")


def full_sets(given: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, text; wanted sets (row, key, said, d1, d2) -> row, hashes of each, stored. The texts are read again, but only the wanted ones are taken."""
    near = _only(given.withColumn("said", F.xxhash64("text")), wanted, "said")
    wanted = wanted.withColumnRenamed("key", "own")
    texts = near.join(wanted.select("own", "said").distinct(), near["said"].eqNullSafe(wanted["said"]) & F.col("key").eqNullSafe(F.col("own")), "left_semi")

    def made(batches):
        for batch in parts(batches):
            sets = [shingle_hashes(x) for x in batch.column("text").to_pylist()]
            digests = np.array([_digest(x) for x in sets], dtype=np.int64)
            hashes = pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy()), hashes], ["d1", "d2", "hashes"])

    found = texts.select("text").mapInArrow(made, "d1 long, d2 long, hashes array<long>")
    found = found.groupBy("d1", "d2").agg(F.first("hashes").alias("hashes"))
    return materialize(found.join(wanted.select("row", "d1", "d2"), ["d1", "d2"]).select("row", "hashes"), "full-sets")


def _rows_of(column: pa.Array) -> np.ndarray:
    """A column of registers as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)


def _folded(start: np.ndarray, values: np.ndarray) -> np.ndarray:
    """64 bits of each row of values (last axis), begun with start."""
    found = start
    for i in range(values.shape[-1]):
        found = _mix(found + _GOLDEN + values[..., i].astype(np.uint64))
    return found


def _buckets_of(values: np.ndarray) -> np.ndarray:
    """The bucket of each band, for rows of registers."""
    values = values.reshape(-1, BANDS, ROWS)
    start = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _GOLDEN, values.shape[:2])
    return _folded(start, values).view(np.int64)


def _filed(batches):
    """row, registers -> row, bucket: one for each band."""
    for batch in batches:
        buckets = _buckets_of(_rows_of(batch.column("registers"))).ravel()
        rows = np.repeat(batch.column("row").to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(rows)], ["bucket", "row"])


def _signed(batches):
    """row, n, registers -> row, n and a bit of each register in four longs."""
    for batch in batches:
        bits = np.zeros((batch.num_rows, 256), dtype=np.uint8)
        values = _rows_of(batch.column("registers")).astype(np.uint64)
        places = np.arange(REGISTERS, dtype=np.uint64) * _GOLDEN
        bits[:, :REGISTERS] = _mix(values + places) & np.uint64(1)
        packed = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("n"), *(pa.array(packed[:, i].copy()) for i in range(4))], ["row", "n", "s0", "s1", "s2", "s3"]
        )


def _likely(batches):
    """a, b, n_a, n_b, r_a, r_b -> the pairs whose registers do not speak against the asked similarity."""
    for batch in parts(batches, 4_096):
        n_a, n_b = (batch.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b"))
        short = estimate(_rows_of(batch.column("r_a")), _rows_of(batch.column("r_b")), n_a, n_b)[1]
        yield batch.select(["a", "b"]).filter(pa.array(short <= MARGIN))


def _size_allows(a: str | Column, b: str | Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * SIMILAR


def _only(rows: DataFrame, needed: DataFrame, by: str = "row") -> DataFrame:
    """``rows`` whose column ``by`` is in ``needed``. A bitmap of ``FILTER_BITS`` hash values, broadcast, keeps most others out of the shuffle."""
    place = F.xxhash64(by).bitwiseAND(F.lit(FILTER_BITS - 1))
    word, bit = F.shiftright(place, 6), place.bitwiseAND(63).cast("int")
    words = needed.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    near = rows.withColumn("word", word).join(F.broadcast(words), "word").where(F.getbit("bits", bit) == 1).drop("word", "bits")
    return near.join(needed.select(by), by, "left_semi")


def confirmed(pairs: DataFrame, spoken: DataFrame, full: DataFrame) -> DataFrame:
    """The candidate pairs (a, b; rows of the sets) that are similar, stored. First by row, n, registers, then by row, hashes."""
    pairs = materialize(pairs, "candidates")
    needed = materialize(pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct(), "candidate-sets")
    small = materialize(_only(spoken, needed), "registers")
    a = small.toDF("a", "n_a", "r_a")
    b = small.toDF("b", "n_b", "r_b")
    both = pairs.join(a, "a").join(b, "b").where(_size_allows("n_a", "n_b"))
    likely = materialize(both.mapInArrow(_likely, "a long, b long"), "likely-pairs")
    needed = materialize(likely.select(F.col("a").alias("row")).union(likely.select("b")).distinct(), "likely-sets")
    sets = materialize(_only(full, needed), "sets")
    full = likely.join(sets.toDF("a", "h_a"), "a").join(sets.toDF("b", "h_b"), "b")
    common = F.size(F.array_intersect("h_a", "h_b"))
    enough = 100 * common >= SIMILAR * (F.size("h_a") + F.size("h_b") - common)
    return materialize(full.where(enough).select("a", "b"), "similar-pairs")


def _pairs_within(few: DataFrame, members: DataFrame, on: list[str]) -> DataFrame:
    """Members of buckets (row, part, n, s0..s3), and some of them -> candidate pairs that one of the few takes part in."""
    names = ["row", "part", "n", "s0", "s1", "s2", "s3"]
    a = few.select(*on, *(F.col(x).alias(f"a_{x}") for x in names))
    b = members.select(*on, *(F.col(x).alias(f"b_{x}") for x in names))
    apart = sum((F.bit_count(F.col(f"a_s{i}").bitwiseXOR(F.col(f"b_s{i}"))) for i in range(4)), F.lit(0))
    near = a.join(b, on).where((F.col("a_part") != F.col("b_part")) & _size_allows("a_n", "b_n") & (apart <= BITS_APART))
    return near.select(F.least("a_row", "b_row").alias("a"), F.greatest("a_row", "b_row").alias("b"))


def _blocks(members: DataFrame) -> DataFrame:
    """Members of large buckets (bucket, row, part, n) -> row, part, n, own, cluster, x, y: each set, once for every pair of blocks (x, y) that its own is in.

    Buckets that share sets are one cluster, dealt to blocks of some ``BLOCK`` sets, so that a set which is in many of them
    is sent no more often than if it were in one. Each two sets of a cluster meet in one pair of blocks.
    """
    least = members.groupBy("bucket").agg(F.min("row").alias("a"))
    linked = stars(members.join(least, "bucket").select("a", F.col("row").alias("b")))
    sets = members.select("row", "part", "n").distinct().join(linked, F.col("row") == F.col("node"), "left")
    sets = materialize(sets.select("row", "part", "n", F.coalesce("root", "row").alias("cluster")), "crowded-sets")
    sizes = sets.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = sets.join(sizes, "cluster").withColumn("own", F.pmod(F.xxhash64("cluster", "row"), "blocks").cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(F.least("own", i).alias("x"), F.greatest("own", i).alias("y")))
    return dealt.select("row", "part", "n", "own", "cluster", F.inline(others))


def _similar_in_blocks(table: pa.Table) -> pa.Table:
    """One pair of blocks (row, part, n, registers, hashes, own, x, y) -> a, b: its similar pairs of different parts that share a band."""
    out = []
    own, x, y = (table.column(c).to_numpy() for c in ("own", "x", "y"))
    row, part, n = (table.column(c).to_numpy() for c in ("row", "part", "n"))
    values, hashes = _rows_of(table.column("registers")), table.column("hashes")
    bands = _buckets_of(values)
    left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
    same_block = len(left) and x[0] == y[0]
    sets = {}

    def full(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = hashes[i].values.to_numpy()
        return sets[i]

    met = []
    for i in left:
        js = right[right > i] if same_block else right
        js = js[(part[js] != part[i]) & (100 * np.minimum(n[js], n[i]) >= SIMILAR * np.maximum(n[js], n[i]))]
        js = js[(bands[js] == bands[i]).any(axis=1)]
        if len(js):
            met.append(np.stack([np.full(len(js), i), js]))
    pairs = np.concatenate(met, axis=1) if met else np.zeros((2, 0), dtype=np.intp)
    for start in range(0, pairs.shape[1], 8_192):
        i, j = pairs[:, start : start + 8_192]
        likely = estimate(values[i], values[j], n[i].astype(float), n[j].astype(float))[1] <= MARGIN
        for i, j in zip(i[likely], j[likely]):
            common = len(np.intersect1d(full(i), full(j), assume_unique=True))
            if 100 * common >= SIMILAR * (n[i] + n[j] - common):
                out.append((min(row[i], row[j]), max(row[i], row[j])))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def _mixed(placed: DataFrame) -> DataFrame:
    """bucket, row, part -> those of buckets with several parts, stored, with size, most (the part with most sets) and others (sets beside it)."""
    counts = placed.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    whole = counts.groupBy("bucket").agg(F.sum("n").alias("size"), F.max(F.struct("n", "part")).alias("m")).where("m.n < size")
    whole = whole.select("bucket", "size", F.col("m.part").alias("most"), (F.col("size") - F.col("m.n")).alias("others"))
    return materialize(placed.select("bucket", "row", "part").join(whole, "bucket"), "open-buckets")


def links(given: DataFrame, marked: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct sets (row of ``marked``) -> (a, b), similar pairs whose components are those of all similar pairs."""
    spoken = marked.select("row", "registers").join(sets.select("row"), "row", "left_semi")
    filed = materialize(spoken.mapInArrow(_filed, "bucket long, row long"), "bands")
    sizes = filed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = materialize(filed.join(sizes, "bucket"), "shared-bands")
    # A set that meets many others is amid them: its text is nearer to each of them than they are to one another.
    met = materialize(shared.groupBy("row").agg(F.sum("size").alias("met")), "met")
    pivots = shared.join(met, "row").groupBy("bucket").agg(F.max(F.struct("met", F.negative("row").alias("row")))["row"].alias("pivot"))
    spokes = shared.join(pivots.select("bucket", F.negative("pivot").alias("pivot")), "bucket").where("row <> pivot")
    # From here on only sets that share a bucket matter.
    meeting = materialize(shared.select("row").distinct(), "meeting")
    spoken = materialize(_only(marked, meeting), "meeting-sets")
    full = full_sets(given, spoken.select("row", "key", "said", "d1", "d2"))
    spoken = spoken.select("row", "n", "registers")
    found = confirmed(spokes.select(F.least("row", "pivot").alias("a"), F.greatest("row", "pivot").alias("b")).distinct(), spoken, full)
    # Buckets of two are done, and so are those whose sets are in one component by now.
    roots = materialize(stars(found), "components")
    placed = shared.where("size > 2").join(roots, F.col("row") == F.col("node"), "left")
    placed = placed.select("bucket", "row", F.coalesce("root", "row").alias("part"))
    bits = spoken.mapInArrow(_signed, "row long, n long, s0 long, s1 long, s2 long, s3 long")
    open_ = _mixed(placed)
    signed = materialize(open_.join(bits, "row"), "signed-buckets")
    few = F.expr(f"others <= {FEW}")
    bounded, crowded = signed.where(few), signed.where(~few)
    pairs = _pairs_within(bounded.where("part <> most"), bounded, ["bucket"]).distinct()
    found = found.unionByName(confirmed(pairs, spoken, full))
    dealt = _blocks(crowded.select("bucket", "row", "part", "n"))
    whole = dealt.join(spoken.select("row", "registers"), "row").join(full, "row")
    whole = whole.select("cluster", "x", "y", "own", "row", "part", "n", "registers", "hashes")
    return found.unionByName(materialize(whole.groupBy("cluster", "x", "y").applyInArrow(_similar_in_blocks, "a long, b long"), "crowded-pairs"))


def components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n (distinct shingles), component (the smallest key that links reach) and kept (the key is the component's) of every row.

    A text without words, or null, has an empty set and is linked with nothing, not even with another one. A text of fewer
    words than a shingle is one shingle. Rows without key take part; a component's id is its smallest key that is not null
    (null if there is none), and a row without key is not kept. Rows that repeat a key stay, each with its own text's
    component. Long texts are taken whole. An empty table gives no rows.
    """
    given = pick(docs, key=key, text=text)
    marked = sketched(given)
    full = marked.where("n > 0")
    sets = materialize(full.groupBy("d1", "d2").agg(F.min("row").alias("row"), F.min("key").alias("least")), "distinct-sets")
    star = stars(links(given, marked, sets))
    placed = sets.join(star, F.col("row") == F.col("node"), "left").withColumn("root", F.coalesce("root", "row"))
    placed = materialize(placed.select("d1", "d2", "root", "least"), "classes")
    named = placed.groupBy("root").agg(F.min("least").alias("component"))
    classes = materialize(placed.join(named, "root").select("d1", "d2", "component"), "named-classes")
    # Stored, so that both sides of the join are plain shuffles and Spark may split a set that many rows have.
    linked = full.select("key", "n", "d1", "d2").join(classes, ["d1", "d2"]).select("key", "n", "component")
    alone = marked.where("n = 0").select("key", "n", F.col("key").alias("component"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("key") == F.col("component"), F.lit(False)))
