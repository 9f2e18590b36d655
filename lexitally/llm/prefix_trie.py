"""The prefix tree of all conversations, counted without building it.

A prefix is named by the 128-bit sum of hashes of its turns with their places, so the
names of all prefixes of a conversation are a running sum. Numbering turns and
running sums go over ranges of the table in the order of (conversation, turn): a
range sums for itself, and what ranges before it hold of its first conversation
is added afterwards (one row a range goes through the driver). A conversation that
holds a third of all turns is thus spread over many tasks.

1. Screening: a count-min sketch of all names. An estimate of one proves that only one
   conversation has the prefix; its node is written by the task that holds the
   turn, and nothing of it is shuffled. The sketch grows with the input up to
   `cells` counters; a full one screens less, but the result is the same.
2. Only prefixes that may be shared are grouped by name: members, ends, the smallest
   member (the node's representative).
3. Representatives only get larger going down, so a conversation represents its nodes
   from one depth on. From that depth, the words before it and whether the
   conversation ends in a leaf of its own, all sums over subtrees become sums over
   members, which one grouping adds up; no level is visited after another.
4. The ids that end at a node are sorted by ranges over all nodes, joined to chunks of
   text, and hashed in order: one stream of chunks a node, never a list in memory.
   (SHA-256 of one text can't be split, so a node's chunks do pass through one task.)

Groups are reduced in map tasks before they shuffle; joins by name or conversation are
plain joins that Spark splits where one key has very many rows.

Defined results: rows without a conversation id take no part; turns are ordered by
turn (null first), then role, then text, so ties and repeated rows have an order
and all count; null roles and texts are empty; an empty table gives no rows.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexitally.llm.text import words
from lexitally.session import stage_folder, stored

ROWS = 4
CELLS = 1 << 23
_CHUNK = 4096
_BLOCK = 1 << 15
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def _mixed(h):
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _running(batches, amounts):
    """Per batch of rows sorted by conversation, the running sums of `amounts(batch)` inside each conversation of this task."""
    last, before = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
        sums = [np.cumsum(a) for a in amounts(batch)]  # unsigned, so they wrap
        new = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        run = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(ids))))
        for j, total in enumerate(sums):
            start = np.where(new > 0, total[new - 1], np.uint64(0))
            if last == ids[0]:
                start[0] -= before[j]
            sums[j] = total - start[run]
        last, before = ids[-1], [s[-1] for s in sums]
        yield batch, ids, sums


def _carried(ends, n):
    """part -> (conversation, sums): what earlier ranges hold of a range's first conversation.

    `ends`: one row a range with its first and last conversation and the last one's `n` sums.
    """
    out, conv, held = {}, None, [0] * n
    for row in sorted(ends, key=lambda r: r[0]):
        part, first, last, sums = row[0], row[1], row[2], [int(x) % 2**64 for x in row[3:]]
        if conv == first:
            out[part] = conv, list(held)
        goes_on = first == last and conv == first
        held = [(h + s) % 2**64 for h, s in zip(held, sums)] if goes_on else sums
        conv = last
    return out


def _edges(rows, columns):
    """One row a range: part, first and last conversation, the last one's largest place and its sums there."""
    last = F.max_by(F.struct("conv_id", *columns), F.struct("conv_id", "place")).alias("_last")
    found = rows.groupBy("part").agg(F.min("conv_id").alias("_first"), last).select("part", "_first", "_last.*")
    return [tuple(r) for r in found.collect()]  # bounded by the number of partitions


def _ranged(rows, *order):
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def _with_carry(rows, carry, n, schema):
    """Add the carried sums to the first `n` columns after conv_id and part."""

    def added(batches):
        for batch in batches:
            columns = batch.columns
            parts, ids = columns[1].to_numpy(), columns[0].to_numpy()
            for part in set(parts.tolist()) & set(carry):
                conv, sums = carry[part]
                here = (parts == part) & (ids == conv)
                for j in range(n):
                    values = columns[2 + j].to_numpy().view(np.uint64) + np.where(here, np.uint64(sums[j]), np.uint64(0))
                    columns[2 + j] = pa.array(values.view(np.int64))
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return rows.mapInArrow(added, schema) if carry else rows


def numbered_turns(conversations, keep, conv="conv_id", turn="turn", role="role", text="text"):
    """(conv_id, part, place, a, b, words): every turn's place from 1 on, the 128-bit hash of role and text, and the words of the text.

    `part` is the range that numbered the turn.
    """
    column = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = conversations.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), column(role).alias("role"), column(text).alias("text")
    ).withColumn("n", F.coalesce(F.size(words(F.col("text"))), F.lit(0)).cast("long"))
    schema = "conv_id long, part int, place long, a long, b long, words long"

    def number(batches):
        part = TaskContext.get().partitionId()
        for batch, ids, (place,) in _running(batches, lambda b: [np.ones(b.num_rows, np.uint64)]):
            hashed = b"".join(
                hashlib.blake2b(b"%d\0%b\0%b" % (len(r), r, t), digest_size=16).digest()
                for r, t in zip(batch.column("role").cast(pa.binary()).to_pylist(), batch.column("text").cast(pa.binary()).to_pylist())
            )
            a, b = np.frombuffer(hashed, np.int64).reshape(-1, 2).T
            parts = np.full(len(ids), part, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(parts), pa.array(place.view(np.int64)), pa.array(a.copy()), pa.array(b.copy()), batch.column("n")],
                ["conv_id", "part", "place", "a", "b", "words"],
            )

    found = keep(_ranged(rows, "conv_id", "turn", "role", "text").mapInArrow(number, schema), "numbered")
    return _with_carry(found, _carried(_edges(found, ["place"]), 1), 1, schema)


def prefixes(turns, keep):
    """(conv_id, part, a, b, words, place, own, a0, b0): every prefix by its last turn.

    a, b: its name, a0, b0: the name without the last turn; words: of all its turns, own: of the last.
    """
    schema = "conv_id long, part int, a long, b long, words long, place long, own long, ta long, tb long"

    def name(batches):
        part = TaskContext.get().partitionId()

        def amounts(batch):
            place = batch.column("place").to_numpy().view(np.uint64)
            terms = [_mixed(batch.column(c).to_numpy().view(np.uint64) + place * _ODD[j]) for j, c in enumerate("ab")]
            amounts.terms = terms
            return [*terms, batch.column("words").to_numpy().view(np.uint64)]

        for batch, ids, sums in _running(batches, amounts):
            long = lambda x: pa.array(x.view(np.int64))
            parts = pa.array(np.full(len(ids), part, np.int32))
            columns = [batch.column("conv_id"), parts, *map(long, sums), batch.column("place"), batch.column("words"), *map(long, amounts.terms)]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "a", "b", "words", "place", "own", "ta", "tb"])

    narrow = turns.select("conv_id", "place", "a", "b", "words")
    found = keep(_ranged(narrow, "conv_id", "place").mapInArrow(name, schema), "prefixes")
    return _with_carry(found, _carried(_edges(found, ["a", "b", "words"]), 3), 3, schema)


def _cells(a, b, width):
    """The counters of a name in each row of the sketch."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    return [(_mixed(a + np.uint64(r) * b) % np.uint64(width)).astype(np.int64) + r * width for r in range(ROWS)]


def count_min(found, n, cells=CELLS):
    """The sketch of all names as one array of counters that stop at 2, and its width."""
    width = max(_BLOCK, min(cells // ROWS, 1 << (4 * max(n, 1) - 1).bit_length()))

    def counted(batches):
        sketch = np.zeros(ROWS * width, np.uint8)
        for batch in batches:
            for at in _cells(batch.column(0).to_numpy(), batch.column(1).to_numpy(), width):
                place, times = np.unique(at, return_counts=True)
                sketch[place] = np.minimum(sketch[place] + np.minimum(times, 2), 2)
        blocks = sketch.reshape(-1, _BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        for i in some:
            yield pa.RecordBatch.from_arrays([pa.array([int(i)], pa.int32()), pa.array([blocks[i].tobytes()], pa.binary())], ["block", "counts"])

    def merged(batches):
        block, total = None, None
        for batch in batches:
            for i, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i != block:
                    if block is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["block", "counts"])
                    block, total = i, np.zeros(_BLOCK, np.uint8)
                total = np.minimum(total + np.frombuffer(counts, np.uint8), 2)
        if block is not None:
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["block", "counts"])

    schema = "block int, counts binary"
    parts = found.select("a", "b").mapInArrow(counted, schema)
    whole = parts.repartition("block").sortWithinPartitions("block").mapInArrow(merged, schema).toArrow()  # at most `cells` bytes
    sketch = np.zeros((ROWS * width // _BLOCK, _BLOCK), np.uint8)
    for i, counts in zip(whole.column(0).to_pylist(), whole.column(1).to_pylist()):
        sketch[i] = np.frombuffer(counts, np.uint8)
    return sketch.ravel(), width


def screened(found, sketch, width):
    """Add `alone` and `alone0`: the estimates prove that one conversation only has the prefix, and the one a turn shorter."""
    shared = found.sparkSession.sparkContext.broadcast(sketch)

    def estimate(a, b):
        counts = shared.value
        return np.min([counts[at] for at in _cells(a, b, width)], axis=0) <= 1

    def look(batches):
        for batch in batches:
            a, b, ta, tb = (batch.column(c).to_numpy().view(np.uint64) for c in ("a", "b", "ta", "tb"))
            alone = estimate(a, b)
            before = np.zeros(len(alone), bool)
            deeper = np.flatnonzero(alone & (batch.column("place").to_numpy() > 1))
            before[deeper] = estimate((a - ta)[deeper], (b - tb)[deeper])
            columns = [batch.column(c) for c in ("conv_id", "a", "b", "words", "place", "own")] + [pa.array(alone), pa.array(before)]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "a", "b", "words", "place", "own", "alone", "alone0"])

    return found.mapInArrow(look, "conv_id long, a long, b long, words long, place long, own long, alone boolean, alone0 boolean")


def joined_hash(ends):
    """(a, b, ends_sha256) of rows (a, b, conv_id): SHA-256 of each name's ids in order, joined by commas."""
    text = "a long, b long, part int, n long, chunk binary"

    def chunks(batches):
        part, n, key, held = TaskContext.get().partitionId(), 0, None, []

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([part], pa.int32()), pa.array([n], pa.int64()),
                 pa.array([",".join(held).encode()], pa.binary())], ["a", "b", "part", "n", "chunk"])

        for batch in batches:
            for a, b, conv in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "conv_id"))):
                if held and ((a, b) != key or len(held) == _CHUNK):
                    yield out()
                    n, held = n + 1, []
                key = a, b
                held.append(str(conv))
        if held:
            yield out()

    def hashed(batches):
        key, running = None, None

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([running.hexdigest()])], ["a", "b", "ends_sha256"])

        for batch in batches:
            for a, b, chunk in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "chunk"))):
                if (a, b) != key:
                    if key is not None:
                        yield out()
                    key, running = (a, b), hashlib.sha256(chunk)
                else:
                    running.update(b"," + chunk)
        if key is not None:
            yield out()

    pieces = _ranged(ends, "a", "b", "conv_id").mapInArrow(chunks, text)
    return pieces.repartition("a", "b").sortWithinPartitions("a", "b", "part", "n").mapInArrow(hashed, "a long, b long, ends_sha256 string")


NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(turns, conversations, keep, cells=CELLS):
    """One row a node (`NODES`) of the tree of all conversations, from the root on; a stored table.

    turns: (conv_id, place, a, b, words) with places from 1 without gaps; conversations: (conv_id), each once, those without turns too.
    """
    found = prefixes(turns, keep)
    sketch, width = count_min(found, found.count(), cells)
    seen = keep(screened(found, sketch, width), "screened")
    sizes = keep(
        conversations.join(seen.groupBy("conv_id").agg(F.max("place").alias("size"), F.max_by(F.struct("a", "b", "alone"), "place").alias("end")), "conv_id", "left")
        .select("conv_id", F.coalesce("size", F.lit(0)).cast("long").alias("size"), F.coalesce("end.alone", F.lit(False)).alias("alone")),
        "sizes",
    )
    root = sizes.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("first")).first()
    maybe = keep(seen.where(~F.col("alone")).drop("alone", "alone0").join(sizes.select("conv_id", "size"), "conv_id"), "shared")
    ended = F.col("place") == F.col("size")
    groups = keep(
        maybe.groupBy("a", "b").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("first"), F.count_if(ended).alias("n_ends")), "groups"
    )
    held = maybe.join(groups, ["a", "b"])
    # Per conversation: the last prefix it does not represent, and whether it represents a leaf.
    above = F.struct("place", "first", "words")
    own = held.groupBy("conv_id").agg(
        F.max(F.when(F.col("first") != F.col("conv_id"), above)).alias("_above"),
        F.max(ended & (F.col("first") == F.col("conv_id")) & (F.col("n_ends") == F.col("n_convs"))).alias("_leaf"),
    )
    own = keep(
        sizes.join(own, "conv_id", "left").select(
            "conv_id", "size", F.coalesce("_above.place", F.lit(0)).alias("depth0"), F.coalesce("_above.first", F.lit(root["first"])).alias("parent"),
            F.coalesce("_above.words", F.lit(0)).alias("words0"), (F.col("alone") | F.coalesce("_leaf", F.lit(False))).cast("long").alias("leaf"),
        ), "own",
    )
    members = maybe.join(own.drop("size"), "conv_id")
    upper = F.when(F.col("place") > F.col("depth0") + 1, F.col("conv_id")).otherwise(F.col("parent"))
    goes_on = (F.col("size") > F.col("place")) & (F.col("depth0") <= F.col("place"))
    deeper = F.when(F.col("depth0") >= F.col("place"), F.col("words0") - F.col("words") + F.col("own")).otherwise(0)
    ends = joined_hash(maybe.where(ended).select("a", "b", "conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    shared = members.groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.min("place").alias("depth"), F.min_by(upper, "conv_id").alias("parent_conv_id"), F.count("*").alias("n_convs"),
        F.count_if(goes_on).alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum(deeper).alias("saved_tokens"),
    ).join(ends, ["a", "b"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none)).select(*NODES)

    tails = seen.where("alone").join(sizes.select("conv_id", "size"), "conv_id")
    tail = lambda rows, parent: rows.select(
        "conv_id", F.col("place").alias("depth"), parent.alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        (F.col("place") < F.col("size")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(ended, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(none).alias("ends_sha256"),
    )
    inner = tail(tails.where("alone0"), F.col("conv_id"))
    tops = tail(tails.where(~F.col("alone0")).join(own.drop("size"), "conv_id"), upper)

    turnless = joined_hash(own.where("size = 0").select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "conv_id"))
    sums = own.agg(
        F.min("conv_id").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.count("*").alias("n_convs"),
        F.count_if((F.col("size") > 0) & (F.col("depth0") == 0)).alias("n_children"), F.greatest(F.sum("leaf"), F.lit(1)).alias("n_leaves"),
        F.sum("words0").alias("saved_tokens"),
    ).where("n_convs > 0")
    top = sums.join(turnless.select("ends_sha256"), F.lit(True), "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none)).select(*NODES)
    return stored(shared.unionByName(inner).unionByName(tops).unionByName(top), "prefix-trie")


def conversation_trie(conversations, rebuild=None, cells=CELLS, **columns):
    """`prefix_trie` of a table of turns; `rebuild` may change the numbered turns and give (turns, conversations) first."""
    with stage_folder(conversations.sparkSession, "prefix-trie") as keep:
        turns = keep(numbered_turns(conversations, keep, **columns), "turns")
        ids = turns.select("conv_id").distinct()
        turns, ids = rebuild(turns, ids) if rebuild else (turns, ids)
        return prefix_trie(turns, ids, keep, cells)


def with_shared_head(turns, ids, every=20, most=4):
    """Every conversation c starts with the first h turns of conversation c - c % every, in place of its own first h; h = crc32(c) % most."""
    heads = Window.partitionBy("conv_id").orderBy("place")
    first = turns.where((F.col("conv_id") % every == 0) & (F.col("place") < most)).withColumn("_n", F.row_number().over(heads)).where(F.col("_n") < most)
    head = first.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("place", "a", "b", "words"))).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h")).join(head, "base", "left")
    convs = convs.withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<place:bigint,a:bigint,b:bigint,words:bigint>>")), F.lit(1), F.col("h").cast("int")))
    from_head = convs.select("conv_id", F.inline("head"))
    own = turns.join(convs.select("conv_id", "h", F.size("head").alias("_k")), "conv_id").where(F.col("place") > F.col("h"))
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("_k")).alias("place"), "a", "b", "words")
    return from_head.unionByName(own), ids
