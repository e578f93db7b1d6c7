"""The trie of conversations by their first turns, rolled up in bands of depth."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quitanda.llm.tables import small_batches, stored, with_key_values
from quitanda.operators.ordered import ordered_totals

# Depths of a band: a node adds to at most so many of its ancestors at a time.
HEIGHT = 8
# Conversations come in families of so many, the first of which lends its first turns to the others.
FAMILY, LENT = 5, 9
LANES = 4
# Characters of role and text by which rows of one turn are ordered, before a hash of both.
TIE = 64
RUN = 50_000
_NOTHING = sha256(b"").hexdigest()


def turns(rows: DataFrame) -> DataFrame:
    """(conv, pos, digest, n_bytes): the turns of every conversation in order, numbered from 1; stored.

    Ordered by turn (NULL first), then by the first 64 characters of role and text and a hash of both;
    equal rows cannot be told apart. NULL roles and texts are empty. Rows without a conv_id belong to no
    conversation. Rows are cut into slices by that order, so no conversation is too long for a task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    known = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").alias("_turn"),
        F.substring(role, 1, TIE).alias("_role"),
        F.substring(text, 1, TIE).alias("_text"),
        F.sha2(name, 256).alias("digest"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.monotonically_increasing_id().alias("_uid"),
    )
    order = [F.col(c) for c in ("conv", "_turn", "_role", "_text", "digest", "_uid")]
    numbered = ordered_totals(known, order, ranks={"pos": ["conv"]})
    return stored(numbered.select("conv", F.col("pos").cast("bigint").alias("pos"), "digest", "n_bytes"), "turns")


def _lent() -> Column:
    return F.crc32(F.col("conv").cast("string").cast("binary")) % LENT


def rebuilt(numbered: DataFrame) -> DataFrame:
    """(conv, depth, digest, n_bytes): every conversation begins with the first h turns of its family's
    first one (or as many as that has) and goes on with its own turns after its first h.

    ``h`` is a checksum of conv modulo 9. The first of a family of five is itself.
    """
    base = F.col("conv") - F.pmod("conv", F.lit(FAMILY))
    lengths = numbered.groupBy("conv").agg(F.max("pos").alias("length"))
    convs = stored(lengths.select("conv", "length", base.alias("base"), _lent().alias("h")), "conversations")
    is_base = F.col("conv") == F.col("base")
    families = convs.groupBy("base").agg(
        F.coalesce(F.max(F.when(is_base, F.col("length"))), F.lit(0)).alias("lends"), F.sum("length").alias("rows")
    )
    own = numbered.select("*", base.alias("base"), _lent().alias("h")).where(is_base | (F.col("pos") > F.col("h")))
    own = with_key_values(own, stored(families, "families"), "base", "rows", ["lends"])
    depth = F.when(is_base, F.col("pos")).otherwise(F.col("pos") - F.col("h") + F.least("h", "lends"))
    own = own.select("conv", depth.alias("depth"), "digest", "n_bytes")
    first = numbered.where((F.pmod("conv", F.lit(FAMILY)) == 0) & (F.col("pos") < LENT))
    first = first.select(F.col("conv").alias("_base"), F.col("pos").alias("depth"), "digest", "n_bytes")
    others = convs.where(~is_base).select("conv", "base", "h")
    borrowed = others.join(first, (F.col("base") == F.col("_base")) & (F.col("depth") <= F.col("h")))
    return own.unionByName(borrowed.select(*own.columns))


def _id(lanes: list[Column]) -> Column:
    low = F.lit((1 << 32) - 1).cast("bigint")
    return F.concat(*[F.lpad(F.hex(lane.bitwiseAND(low)), 8, "0") for lane in lanes])


def paths(sequences: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv, depth, id, parent, n_bytes): the nodes every conversation goes through, the root included.

    A node is the sequence of turns down to it. Its id is the sum of hashes of (depth, turn), 4 x 32
    bits, a running total: so a conversation may be cut anywhere, and its parent's is the difference.
    """
    named = F.sha2(F.concat_ws(":", "depth", "digest").cast("binary"), 256)
    lanes = [F.conv(F.substring("_name", 1 + 8 * k, 8), 16, 10).cast("bigint").alias(f"_h{k}") for k in range(LANES)]
    hashed = sequences.withColumn("_name", named).select("conv", "depth", "n_bytes", *lanes)
    sums = {f"_s{k}": (f"_h{k}", ["conv"]) for k in range(LANES)}
    summed = ordered_totals(hashed, [F.col("conv"), F.col("depth")], sums=sums)
    after = [F.col(f"_s{k}") for k in range(LANES)]
    before = [F.col(f"_s{k}") - F.col(f"_h{k}") for k in range(LANES)]
    below = summed.select("conv", "depth", _id(after).alias("id"), _id(before).alias("parent"), "n_bytes")
    none = F.lit("0" * 8 * LANES)
    roots = conversations.select(
        "conv", F.lit(0).cast("bigint").alias("depth"), none.alias("id"), F.lit(None).cast("string").alias("parent"),
        F.lit(0).cast("bigint").alias("n_bytes"),
    )
    return below.unionByName(roots)


def _banded(rows: DataFrame, level: int) -> DataFrame:
    """(id, up, above) and the members of every node of a level, whose depths are multiples of 8^level.

    ``up`` are the ids from the root of the node's band down to itself; ``above``, for the root of a
    band, those of the band above it on its path. The bands of one conversation are windows of at
    most nine rows.
    """
    step = HEIGHT**level
    at = F.floor(F.col("depth") / step)
    top = (at % HEIGHT == 0) & (at > 0)
    bands = F.when(top, F.array(at / HEIGHT, at / HEIGHT - 1)).otherwise(F.array(F.floor(at / HEIGHT)))
    cut = rows.where(F.col("depth") % step == 0).withColumn("_band", F.explode(bands.cast("array<bigint>")))
    so_far = Window.partitionBy("conv", "_band").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = cut.withColumn("_up", F.collect_list("id").over(so_far))
    tail = F.col("_band") < F.floor(F.floor(F.col("depth") / step) / HEIGHT)
    own = lambda c: F.any_value(F.when(~tail, F.col(c)), ignoreNulls=True).alias(c.lstrip("_"))
    return seen.groupBy("id").agg(
        own("depth"),
        own("parent"),
        own("n_bytes"),
        own("_up"),
        F.any_value(F.when(tail, F.slice("_up", 1, HEIGHT)), ignoreNulls=True).alias("above"),
        F.count_if(~tail).alias("n_convs"),
        F.min("conv").alias("conv"),
    )


def _added(rows: DataFrame, ancestors: str) -> DataFrame:
    """Leaves and saved tokens summed over the named ancestors of every row."""
    to = rows.select(F.explode(ancestors).alias("id"), "n_leaves", "saved_tokens")
    return to.groupBy("id").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def rolled_up(through: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, n_leaves, saved_tokens): sums over subtrees of what ``nodes`` (id, up, above, ...) have themselves.

    Inside a band of eight depths every node adds to its ancestors of that band. The totals that the
    roots of bands get so are the values of a smaller tree, of these roots, which is summed in the
    same way: with bands of eight of its levels, and so on until one band is left. Then each root's
    completed total is added to its ancestors in the band above, level by level. So a depth of n takes
    log8(n) rounds up and down, and a node is repeated at most eight times a round.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    levels, inside, values = [nodes], [], nodes
    while True:
        level = len(inside)
        inside.append(stored(_added(values, "up"), f"band-{level}"))
        if deepest < HEIGHT ** (level + 1):
            break
        levels.append(stored(_banded(through, level + 1).select("id", "up", "above"), f"level-{level + 1}"))
        values = levels[-1].join(inside[-1], "id")
    complete = inside[-1]
    for level in range(len(inside) - 2, -1, -1):
        roots = levels[level].where(F.col("above").isNotNull()).select("id", "above").join(complete, "id")
        more = _added(roots, "above").select(F.col("id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in SUMS])
        added = inside[level].join(more, F.col("id") == F.col("_id"), "left")
        complete = added.select("id", *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in SUMS])
    return complete


SUMS = ("n_leaves", "saved_tokens")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered (id, conv) of a partition: per id the comma-joined numbers, in runs of bounded length."""
    fields = [("id", pa.string()), ("slice", pa.int32()), ("run", pa.int32()), ("listed", pa.string())]
    now, slice_, run, held, out = None, 0, 0, [], []
    for batch in batches:
        for node, part, conv in zip(*[batch[c].to_pylist() for c in ("id", "slice", "conv")], strict=True):
            if held and (node != now or len(held) == RUN):
                out.append({"id": now, "slice": slice_, "run": run, "listed": ",".join(held)})
                run, held = run + 1, []
            now, slice_ = node, part
            held.append(str(conv))
        yield pa.RecordBatch.from_pylist(out, pa.schema(fields))
        out = []
    if held:
        yield pa.RecordBatch.from_pylist([{"id": now, "slice": slice_, "run": run, "listed": ",".join(held)}], pa.schema(fields))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lists of one id, which come in order."""
    schema = pa.schema([("id", pa.string()), ("ends_sha256", pa.string())])
    now, sums, out = None, sha256(), []
    for batch in batches:
        for node, listed in zip(batch["id"].to_pylist(), batch["listed"].to_pylist(), strict=True):
            if node != now:
                if now is not None:
                    out.append({"id": now, "ends_sha256": sums.hexdigest()})
                now, sums = node, sha256(listed.encode())
            else:
                sums.update(b"," + listed.encode())
        yield pa.RecordBatch.from_pylist(out, schema)
        out = []
    if now is not None:
        yield pa.RecordBatch.from_pylist([{"id": now, "ends_sha256": sums.hexdigest()}], schema)


def ends_digests(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256) of the ascending, comma-joined conv numbers of (id, conv).

    Rows are range-partitioned by both and joined to runs where they lie, so that of a node at which
    very many conversations end only runs of 50,000 meet in one task, which hashes them in a stream.
    """
    order = ["id", "conv"]
    cut = ends.repartitionByRange(*order).sortWithinPartitions(*order).select("id", F.spark_partition_id().alias("slice"), "conv")
    runs = stored(small_batches(cut).mapInArrow(_listed, "id string, slice int, run int, listed string"), "ends")
    in_order = runs.repartition("id").sortWithinPartitions("id", "slice", "run").select("id", "listed")
    return small_batches(in_order).mapInArrow(_hashed, "id string, ends_sha256 string")


def trie(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node.

    ``rows`` are (conv_id, turn, role, text); further columns are ignored, also such with names used
    here. A conversation that lends and owns no turn ends at the root; no rows give no node. Equal
    sequences are one node, however many conversations have them: these are counted by aggregates, which
    combine before the shuffle. A node's parent may have very many children, so the parent's row finds
    them by `with_key_values`, which splits hot keys.
    """
    numbered = turns(rows)
    conversations = numbered.select("conv").distinct()
    through = stored(paths(rebuilt(numbered), conversations), "paths")
    last = through.groupBy("conv").agg(F.max(F.struct("depth", "id")).alias("_last"))
    ends = stored(last.select(F.col("_last.id").alias("id"), "conv"), "last")
    ended = ends.groupBy("id").agg(F.count("*").alias("_ended"), F.min("conv").alias("_only"))
    base = _banded(through, 0).join(ended, "id", "left")
    leaf = F.coalesce(F.col("_ended"), F.lit(0)) == F.col("n_convs")
    nodes = base.withColumns({"n_leaves": leaf.cast("bigint"), "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")})
    nodes = stored(nodes, "nodes")
    totals = rolled_up(through, nodes)

    children = nodes.groupBy(F.col("parent").alias("_id")).agg(F.count("*").alias("n_children")).where("_id IS NOT NULL")
    known = nodes.join(children, F.col("id") == F.col("_id"), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    known = stored(known.select("id", "conv", "depth", "parent", "n_convs", "n_children", "_ended", "_only"), "families")
    parents = known.where("n_children > 0").select(F.col("id").alias("parent"), F.col("conv").alias("parent_conv_id"), "n_children")
    joined = with_key_values(known, parents, "parent", "n_children", ["parent_conv_id"])
    many = nodes.where("_ended > 1").select(F.col("id").alias("_many"))
    lists = ends_digests(ends.join(many, F.col("id") == F.col("_many"), "left_semi")).withColumnRenamed("id", "_id")
    one = F.when(F.col("_ended") == 1, F.sha2(F.col("_only").cast("string").cast("binary"), 256)).otherwise(_NOTHING)
    return (
        joined.join(totals, "id")
        .join(lists, F.col("id") == F.col("_id"), "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
            *SUMS, F.coalesce("ends_sha256", one).alias("ends_sha256"),
        )
    )
