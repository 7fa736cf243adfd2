"""The prefix trie of conversations that are rebuilt from parts of others, without building any of them.

A conversation c is rebuilt from the head of another one, its base, and its own turns behind a cut. A turn
is a number t, and a sequence of turns has the product t1 R^(k-1) + ... + tk modulo a prime: products of
parts combine to the product of the whole, so that

    product(head + own turns h+1 .. k) = product(own turns 1 .. k) + (product(head) - product(own turns 1 .. h)) R^(k-h)

and one difference for each conversation turns all its own prefix products into rebuilt ones. Texts stay where
they are; every member of a node carries the product, that of its parent, and a reference to the turn it ends
with. A node is a group of equal products, and it is verified: all its members must name one parent, and the
turns they refer to must be equal to that of its first member. If any is not, all is done anew with another R.

Turns are put in order by one range sort, whose tasks combine the runs of a conversation that they hold; a
conversation with very many turns is many runs, and only the products of whole runs are carried on.
No step follows the depth of the trie. The members of a node's subtree are those of the node itself, so the
saving of a subtree is the sum over its members of what each shares, from the node on, with a smaller
conversation, and the leaves of a subtree are counted by the smallest member of each leaf.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.tables import parts, pick
from shoplens.scratch import materialize

#: The products are modulo this prime (2^61 - 1), and two of them are kept.
PRIME = (1 << 61) - 1
#: Bases R of the two products, by attempt; fixed values without further meaning.
BASES = (
    (0x0A3D70A3D70A3D71, 0x16E1F4C9B28D5A37),
    (0x1B8E5C2F7D94A613, 0x05F3C1D2E4B6978B),
    (0x0E9A7B3C5D1F2468, 0x1C6D8F4A2B3E5970),
)
#: Conversations whose ids are hashed together: ids of one slice of this width are joined in one row first.
SLICE = 4_096
#: Longest head.
HEAD = 8
#: Characters that decide the order of turns with one number.
TIE = 64


def base_of(conv: Column) -> Column:
    """The conversation whose head is used: the one at the last multiple of five."""
    return conv - conv % 5


def head_of(conv: Column) -> Column:
    """How many turns the head has at most: CRC-32 of the id's decimal digits, modulo nine."""
    return (F.crc32(conv.cast("string")) % 9).cast("int")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


_LONG = pa.int64()


def ordered_turns(rows: DataFrame, bases: tuple[int, int], conv: str, turn: str, role: str, text: str) -> DataFrame:
    """All turns in order, stored: run, conv, j (place in the run, from 1), ref, role, text, bytes, and of the run up to here p1, p2, upto, and up1, up2 without the turn itself."""
    given = pick(rows, conv=conv, turn=turn, role=role, text=text).where("conv IS NOT NULL")
    plain = given.select(
        F.col("conv").cast("long").alias("conv"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("ref"),
    )
    marked = plain.withColumns({
        "t1": F.xxhash64("role", "text"), "t2": F.xxhash64(F.lit(1), "text", "role"), "bytes": F.octet_length("text").cast("long"),
        "role_": F.left("role", F.lit(TIE)), "text_": F.left("text", F.lit(TIE)),
    })
    # The sort's sample and bounds reach the driver, so they hold no whole texts.
    order = ["conv", "turn", "role_", "text_", "t1", "t2", "ref"]
    sorted_ = marked.repartitionByRange(*order).sortWithinPartitions(*order).drop("turn", "role_", "text_")
    r1, r2 = bases

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId()
        last, j, p1, p2, upto = None, 0, 0, 0, 0
        for batch in batches:
            out = []
            for c, t1, t2, size in zip(*(batch.column(x).to_pylist() for x in ("conv", "t1", "t2", "bytes"))):
                if c != last:
                    last, j, p1, p2, upto = c, 0, 0, 0, 0
                # A turn is never 0, so a sequence and the same behind further turns differ.
                up1, up2 = p1, p2
                j, p1, p2, upto = j + 1, (p1 * r1 + t1 % (PRIME - 1) + 1) % PRIME, (p2 * r2 + t2 % (PRIME - 1) + 1) % PRIME, upto + size
                out.append((run, j, p1, p2, upto, up1, up2))
            made = _batch(out, ["run", "j", "p1", "p2", "upto", "up1", "up2"], [_LONG] * 7)
            kept = ["conv", "ref", "role", "text", "bytes"]
            yield pa.RecordBatch.from_arrays([*made.columns, *(batch.column(x) for x in kept)], [*made.schema.names, *kept])

    schema = "run long, j long, p1 long, p2 long, upto long, up1 long, up2 long, conv long, ref long, role string, text string, bytes long"
    return materialize(sorted_.mapInArrow(runs, schema), "turns-in-order")


def carried(turns: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """For each run: conv, run, and what comes before it in its conversation: n turns, products c1 and c2, size bytes; and len, all its turns."""
    ends = turns.groupBy("conv", "run").agg(F.max(F.struct("j", "p1", "p2", "upto")).alias("e"))
    # As many runs as the sort has tasks, at most.
    runs = ends.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("run", "e.j", "e.p1", "e.p2", "e.upto"))).alias("runs"))
    r1, r2 = bases

    def folded(batches):
        for batch in batches:
            out = []
            for conv, found in zip(batch.column("conv").to_pylist(), batch.column("runs").to_pylist()):
                n = c1 = c2 = size = 0
                length = sum(run["j"] for run in found)
                for run in found:
                    out.append((conv, run["run"], n, c1, c2, size, length))
                    c1 = (c1 * pow(r1, run["j"], PRIME) + run["p1"]) % PRIME
                    c2 = (c2 * pow(r2, run["j"], PRIME) + run["p2"]) % PRIME
                    n, size = n + run["j"], size + run["upto"]
            yield _batch(out, ["conv", "run", "n", "c1", "c2", "size", "len"], [_LONG] * 7)

    return runs.mapInArrow(folded, "conv long, run long, n long, c1 long, c2 long, size long, len long")


def prefixes(turns: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """Every turn with its conversation up to it: conv, k (from 1), len, ref, bytes, p1, p2 (up1, up2 without the turn) and before (bytes of the turns in front)."""
    placed = turns.drop("role", "text").join(carried(turns, bases), ["conv", "run"])
    r1, r2 = bases

    def combined(batches):
        names = ["conv", "j", "p1", "p2", "up1", "up2", "upto", "bytes", "ref", "n", "c1", "c2", "size", "len"]
        for batch in batches:
            out = []
            for conv, j, p1, p2, up1, up2, upto, own, ref, n, c1, c2, size, length in zip(*(batch.column(x).to_pylist() for x in names)):
                if n:
                    p1, p2 = (c1 * pow(r1, j, PRIME) + p1) % PRIME, (c2 * pow(r2, j, PRIME) + p2) % PRIME
                    up1, up2 = (c1 * pow(r1, j - 1, PRIME) + up1) % PRIME, (c2 * pow(r2, j - 1, PRIME) + up2) % PRIME
                out.append((conv, n + j, length, ref, own, p1, p2, up1, up2, size + upto - own))
            yield _batch(out, ["conv", "k", "len", "ref", "bytes", "p1", "p2", "up1", "up2", "before"], [_LONG] * 10)

    schema = "conv long, k long, len long, ref long, bytes long, p1 long, p2 long, up1 long, up2 long, before long"
    return materialize(placed.mapInArrow(combined, schema), "prefixes")


_MEMBER = ["conv", "depth", "p1", "p2", "up1", "up2", "ref", "bytes", "before", "ends"]
_MEMBER_SCHEMA = "conv long, depth long, p1 long, p2 long, up1 long, up2 long, ref long, bytes long, before long, ends boolean"


def members(
    found: DataFrame, bases: tuple[int, int], base: Callable[[Column], Column] = base_of, head: Callable[[Column], Column] = head_of
) -> DataFrame:
    """A row for each depth of each rebuilt conversation, 0 included: its node's products, its parent's, and the turn it ends with.

    ``head`` must give ``HEAD`` at most: a conversation's first turns up to there are gathered.
    """
    first = F.when(F.col("k") <= HEAD, F.struct("k", "p1", "p2", "ref", "bytes", "before"))
    heads = found.groupBy("conv").agg(F.first("len").alias("len"), F.sort_array(F.collect_list(first)).alias("own"))
    heads = materialize(heads.withColumns({"base": base(F.col("conv")), "h": head(F.col("conv"))}), "heads")
    bases_ = heads.select(F.col("conv").alias("base"), F.col("own").alias("lent"))
    plan = heads.join(bases_, "base", "left").select(
        "conv", "len", "h", "own", F.slice(F.coalesce("lent", F.array().cast(heads.schema["own"].dataType)), 1, F.greatest("h", F.lit(0))).alias("lent")
    )
    r1, r2 = bases

    def headed(batches):
        """What to add to a conversation's own products, and the members that end within the head."""
        for batch in parts(batches, 1_024):
            out = []
            for row in batch.to_pylist():
                h, own, lent = row["h"], row["own"], row["lent"]
                ends = {"p1": 0, "p2": 0, "upto": 0}
                rows = [(0, 0, 0, None, None, None, 0, 0)]
                for d, x in enumerate(lent, 1):
                    rows.append((d, x["p1"], x["p2"], ends["p1"], ends["p2"], x["ref"], x["bytes"], x["before"]))
                    ends = {"p1": x["p1"], "p2": x["p2"], "upto": x["before"] + x["bytes"]}
                cut = own[h - 1] if h and len(own) >= h else {"p1": 0, "p2": 0, "before": 0, "bytes": 0}
                out.append((
                    row["conv"], h, len(lent), (ends["p1"] - cut["p1"]) % PRIME, (ends["p2"] - cut["p2"]) % PRIME,
                    ends["upto"] - cut["before"] - cut["bytes"], row["len"] <= h,
                    [dict(zip(("depth", "p1", "p2", "up1", "up2", "ref", "bytes", "before"), r)) for r in rows],
                ))
            item = pa.struct([(x, _LONG) for x in ("depth", "p1", "p2", "up1", "up2", "ref", "bytes", "before")])
            names = ["conv", "h", "lent", "d1", "d2", "shift", "only_head", "rows"]
            yield _batch(out, names, [_LONG] * 6 + [pa.bool_(), pa.list_(item)])

    item = "struct<depth: long, p1: long, p2: long, up1: long, up2: long, ref: long, bytes: long, before: long>"
    schema = f"conv long, h long, lent long, d1 long, d2 long, shift long, only_head boolean, rows array<{item}>"
    known = materialize(plan.mapInArrow(headed, schema), "rebuilt-heads")
    in_head = known.select("conv", "lent", "only_head", F.inline("rows")).withColumn("ends", F.col("only_head") & (F.col("depth") == F.col("lent")))
    own = known.where("NOT only_head").select("conv", "h", "lent", "d1", "d2", "shift")
    behind = found.join(own, "conv").where("k > h")

    def shifted(batches):
        inverse1, inverse2 = pow(r1, -1, PRIME), pow(r2, -1, PRIME)
        names = ["conv", "k", "len", "ref", "bytes", "p1", "p2", "before", "h", "lent", "d1", "d2", "shift", "up1", "up2"]
        for batch in batches:
            out = []
            for conv, k, length, ref, own, p1, p2, before, h, lent, d1, d2, shift, up1, up2 in zip(*(batch.column(x).to_pylist() for x in names)):
                more1, more2 = d1 * pow(r1, k - h, PRIME), d2 * pow(r2, k - h, PRIME)
                out.append((
                    conv, lent + k - h, (p1 + more1) % PRIME, (p2 + more2) % PRIME,
                    (up1 + more1 * inverse1) % PRIME, (up2 + more2 * inverse2) % PRIME, ref, own, before + shift, k == length,
                ))
            yield _batch(out, _MEMBER, [_LONG] * 9 + [pa.bool_()])

    return materialize(in_head.select(*_MEMBER).unionByName(behind.mapInArrow(shifted, _MEMBER_SCHEMA)), "members")


def trie(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    base: Callable[[Column], Column] = base_of, head: Callable[[Column], Column] = head_of,
) -> DataFrame:
    """The nodes of all rebuilt conversations; see the module for what a node has.

    conv (smallest member), depth, parent (its conv; null for the root), n_convs, n_children, n_leaves, saved, ends_sha256.
    Turns are ordered by turn (null first), then role and text, as far as their first ``TIE`` characters
    tell them apart, then by a hash; repeated rows are repeated turns. A null role or text
    is an empty one, and a turn of both still is a turn. Rows without conversation take no part, ids are whole numbers. A base that does not
    exist lends nothing. Very long texts are hashed where they are and move once, in the sort, and once more where
    two different turns end the same node. An empty table gives no rows, not even a root.
    """
    for bases in BASES:
        turns = ordered_turns(rows, bases, conv, turn, role, text)
        all_ = members(prefixes(turns, bases), bases, base, head)
        groups = materialize(_grouped(all_), "nodes")
        if not _differs(all_, groups, turns):
            return _described(all_, groups)
    raise RuntimeError("two different sequences had equal products in every attempt")


_NODE = ["depth", "p1", "p2"]


def _grouped(all_: DataFrame) -> DataFrame:
    lowest = F.min(F.struct("conv", "ref"))
    parents = F.when(F.col("depth") > 0, F.struct("up1", "up2"))
    return all_.groupBy(*_NODE).agg(
        lowest["conv"].alias("low"), lowest["ref"].alias("low_ref"), F.count("*").alias("n_convs"),
        F.min(parents).alias("parent"), F.max(parents).alias("other_parent"),
        F.min("bytes").alias("bytes"), F.min("before").alias("before"),
    )


def _differs(all_: DataFrame, groups: DataFrame, turns: DataFrame) -> bool:
    """Whether some node has members that differ: in their parents, or in the turns that end them."""
    if not groups.where("parent <> other_parent").isEmpty():
        return True
    pairs = all_.where("depth > 0").select(*_NODE, "ref").join(groups.select(*_NODE, "low_ref"), _NODE)
    pairs = materialize(pairs.where("ref <> low_ref").select("ref", "low_ref").distinct(), "turns-to-compare")
    a = turns.select("ref", F.struct("role", "text").alias("a"))
    b = turns.select(F.col("ref").alias("low_ref"), F.struct("role", "text").alias("b"))
    return not pairs.join(a, "ref").join(b, "low_ref").where("a <> b").isEmpty()


def _described(all_: DataFrame, groups: DataFrame) -> DataFrame:
    children = groups.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent.up1").alias("p1"), F.col("parent.up2").alias("p2")).agg(
        F.count("*").alias("n_children")
    )
    nodes = groups.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = materialize(nodes.drop("other_parent", "low_ref"), "nodes-with-children")
    # Bytes that a conversation has in common with a smaller one, and whether a leaf is counted by it.
    own = nodes.groupBy(F.col("low").alias("conv")).agg(
        F.min("before").alias("shared"), F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf")
    )
    whole = all_.where("ends").select("conv", (F.col("before") + F.col("bytes")).alias("all_bytes"))
    share = whole.join(own, "conv", "left").select("conv", F.coalesce("shared", "all_bytes").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    shared = all_.select("conv", *_NODE, "before").join(materialize(share, "shares"), "conv")
    below = shared.groupBy(*_NODE).agg(
        F.sum("leaf").cast("long").alias("n_leaves"),
        F.sum(F.greatest("shared", "before") - F.col("before")).alias("saved"),
    )
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("up1"), F.col("p2").alias("up2"), F.col("low").alias("parent_conv"))
    named = nodes.withColumns({"up1": F.col("parent.up1"), "up2": F.col("parent.up2")}).join(up, ["depth", "up1", "up2"], "left")
    return (
        named.join(materialize(below, "subtrees"), _NODE)
        .join(materialize(_ends(all_), "ends"), _NODE, "left")
        .select(
            F.col("low").alias("conv"), "depth", F.col("parent_conv").alias("parent"), "n_convs", "n_children", "n_leaves", "saved",
            F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def _ends(all_: DataFrame) -> DataFrame:
    """For each node at which conversations end: the digest of their ids.

    Ids of a slice are joined first, SLICE of them at most. A digest reads its bytes one after the other, so the slices of a node
    stream through one task, held one batch at a time.
    """
    ending = all_.where("ends").select(*_NODE, "conv", F.floor(F.col("conv") / SLICE).alias("slice"))
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    slices = ending.groupBy(*_NODE, "slice").agg(F.array_join(ids, ",").alias("ids"))

    def digests(batches):
        now, digest = None, None
        for batch in batches:
            done = []
            for *node, ids in zip(*(batch.column(x).to_pylist() for x in (*_NODE, "ids"))):
                if node == now:
                    digest.update(b",")
                else:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = node, hashlib.sha256()
                digest.update(ids.encode())
            yield _batch(done, [*_NODE, "sha256"], [_LONG] * 3 + [pa.string()])
        if now is not None:
            yield _batch([(*now, digest.hexdigest())], [*_NODE, "sha256"], [_LONG] * 3 + [pa.string()])

    streamed = slices.repartition(*_NODE).sortWithinPartitions(*_NODE, "slice")
    return streamed.mapInArrow(digests, "depth long, p1 long, p2 long, sha256 string")
