"""Near-duplicate documents by a signature-coordinate inverted join.

A document is its set of 5-word shingles. Equal sets form a class; classes are
linked if their Jaccard similarity is 0.75 or more, checked on the full sets, and
groups are the connected components of the links.

Candidates. A signature has `COORDINATES` min-hash values; a class is posted under
every coordinate-value pair. Linked classes agree in 48 of 64 coordinates on
average; at a similarity of exactly 0.75 fewer than `MATCHES` agreements have a
chance of 4 in ten million, at 0.8 of one in a thousand million. Only classes that agree in `MATCHES` coordinates are compared:
- prefix and skip merging: with pairs ordered by how many classes they hold, two
  classes that agree in t pairs share one of the first (shared pairs - t + 1) of
  each; the t - 1 longest lists of a class are skipped, and a class that shares
  fewer than t pairs with anybody is not posted at all;
- in each list the class with the most company is the hub. Every class is checked
  against the hubs it meets most, so a group of many near copies takes as many
  checks as it has members. Links found give first components;
- a list whose classes are now in one component is done. In the others a component
  with `MANY` classes or more is one row and a candidate for all others in the list;
  these pairs are checked in full, blocks of components against blocks of components
  inside tasks: a class travels once for a block of partners.
  Between the classes of the rest collisions are counted, in blocks of bounded size;
  the first list that two classes share counts their components as candidates if they
  match in `MATCHES` coordinates or more, and in `ALL_MATCHES` with `MORE` others that are
  not posted (both tests miss 4 in ten million at 0.75). All components of a group may be
  candidates for each other without one link, so these pairs are never rows: a task
  reports a spanning forest of them, components of the forest are clusters, and in a
  cluster all are checked against all in full, blocks against blocks inside tasks.

Hot lists and groups are cut into blocks by hash; a list of m classes of many
components costs m^2 / 2 signature comparisons inside tasks, and m rows a block.

Defined results: texts without words and null texts are linked with nothing and
are their own group; rows with a null id are compared with nothing, get a null
component and stay; rows that share an id are one document; an empty table gives
no rows. Shingles are compared by 64-bit hashes.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexitally.functions.guards import row_count
from lexitally.llm.components import connected_components
from lexitally.llm.shingles import MinHash, set_digest, shingle_set
from lexitally.session import stage_folder, stored

COORDINATES = 64
MATCHES = 30
MORE = 64
ALL_MATCHES = 68
PERCENT = 75
BLOCK = 512
HUBS = 2
MANY = 16
BUCKET = 1000


# --- sets and signatures ----------------------------------------------------------


def _batched(batches, build, names, step=512):
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield pa.RecordBatch.from_arrays(build(part), names)


def signed(docs, id_col, text):
    """(id, n_shingles, digest, keys, more): one row per input row; without shingles the last three are null."""
    family = MinHash(COORDINATES + MORE)

    def build(part):
        sets = [shingle_set(t) for t in part.column(1).to_pylist()]
        keys, more = [None] * len(sets), [None] * len(sets)
        full = [i for i, s in enumerate(sets) if len(s)]
        if full:
            for i, row in zip(full, family.signatures([sets[i] for i in full])):
                keys[i] = row[:COORDINATES]
                more[i] = (row[COORDINATES:] >> 16 & 0x7FFFFFFF).astype(np.int32)
        return [
            part.column(0), pa.array([len(s) for s in sets], pa.int64()),
            pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()), pa.array(keys, pa.list_(pa.int64())),
            pa.array(more, pa.list_(pa.int32())),
        ]

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(
        lambda batches: _batched(batches, build, ["id", "n_shingles", "digest", "keys", "more"]),
        f"id {kind}, n_shingles long, digest binary, keys array<long>, more array<int>",
    )


def full_sets(docs, wanted, id_col, text):
    """(cls, shingles): the sets, as packed 64-bit integers, of the classes in `wanted` (cls, digest, label)."""

    def build(part):
        sets = [shingle_set(t) for t in part.column(0).to_pylist()]
        return [pa.array([set_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]

    rows = docs.join(wanted.select(F.col("label").alias("_label")), F.col(f"`{id_col}`") == F.col("_label"), "left_semi").select(F.col(f"`{text}`").alias("text"))
    sets = rows.mapInArrow(lambda batches: _batched(batches, build, ["digest", "shingles"]), "digest binary, shingles binary")
    return sets.join(wanted.select("cls", "digest"), "digest").select("cls", "shingles").dropDuplicates(["cls"])


# --- candidates -----------------------------------------------------------------


def _shared(posted):
    """(cls, key, pos, n): postings under pairs that n >= 2 classes share."""
    counts = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return posted.join(counts, "key")


def prefix_postings(classes, keep, matches=MATCHES):
    """(cls, key, pos, weight): the postings that prefix and skip merging leaves.

    pos: the coordinate; weight: company of the class over all its pairs. `keep` writes a stage table.
    """
    posted = classes.select("cls", F.posexplode("keys").alias("pos", "key"))
    able = _shared(posted).groupBy("cls").agg(F.collect_list(F.struct("key", "pos")).alias("keys")).where(F.size("keys") >= matches)  # at most COORDINATES each
    able = keep(able, "postings")
    lists = _shared(able.select("cls", F.inline("keys"))).groupBy("cls").agg(
        F.array_sort(F.collect_list(F.struct("n", "key", "pos"))).alias("lists"), F.sum("n").alias("weight")
    )
    first = F.slice("lists", 1, F.size("lists") - (matches - 1))
    return lists.where(F.size("lists") >= matches).select("cls", "weight", F.explode(first).alias("x")).select("cls", "weight", "x.key", "x.pos")


def hub_pairs(postings, hubs=HUBS):
    """(g, p): every class p with the hubs g it meets in most lists."""
    best = postings.groupBy("key").agg(F.max(F.struct("weight", "cls")).alias("hub")).select("key", F.col("hub.cls").alias("g"))
    met = postings.join(best, "key").where("g <> cls").groupBy("cls", "g").agg(F.count("*").alias("n"))
    order = Window.partitionBy("cls").orderBy(F.desc("n"), "g")
    return met.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= hubs).select("g", F.col("cls").alias("p"))


def _block(key, n, size):
    """(blocks of at most about `size` for n members, the block of `key`)."""
    blocks = F.ceil(n / size).cast("int")
    return blocks, F.pmod(F.xxhash64(key), blocks).cast("int")


class _Forest:
    """Spanning edges of what has been joined so far."""

    def __init__(self):
        self.parent, self.edges = {}, []

    def root(self, x):
        while (up := self.parent.setdefault(x, x)) != x:
            self.parent[x] = x = self.parent.setdefault(up, up)
        return x

    def join(self, a, others):
        for b in others:
            x, y = self.root(a), self.root(b)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                self.edges.append((a, b))


def open_pairs(postings, classes, component, matches=MATCHES, block=2 * BLOCK):
    """(a, b, whole): candidate pairs of components.

    whole: all pairs of a component with many classes in a list and another one there.
    The others are spanning edges of the pairs with classes that agree in `matches`
    coordinates or more: such components are connected by edges, not each pair has one.
    component: (cls, comp) of the classes that are in one with others.
    """
    short = F.transform("keys", lambda k: F.shiftright(k, 16).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    rows = (
        postings.select("cls", "key", "pos").join(component, "cls", "left")
        .withColumn("comp", F.coalesce("comp", "cls"))
    )
    prefixes = postings.groupBy("cls").agg(F.array_sort(F.collect_list("pos")).alias("first"))  # at most COORDINATES each
    signatures = classes.join(prefixes, "cls").select("cls", "n_shingles", F.concat(short, "more").alias("sig"), "first")
    held = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    many = held.where(F.col("n") >= MANY)
    lists = held.groupBy("key").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b"), F.sum(F.when(F.col("n") < MANY, F.col("n")).otherwise(1)).alias("m"))
    lists = lists.where("_a <> _b").select("key", "m")
    few = rows.join(many.select("key", "comp"), ["key", "comp"], "left_anti").join(lists, "key").join(signatures, "cls")
    whole = many.select("key", "comp").join(lists, "key").withColumn("cls", F.col("comp"))
    blocks, own = _block("cls", F.col("m"), block)
    spread = (
        few.unionByName(whole, allowMissingColumns=True)
        .withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("key", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), "_own", "pos", "comp", "n_shingles", "sig", "first")
    )

    width = F.lit(COORDINATES + MORE)
    spread = spread.withColumn("sig", F.coalesce("sig", F.array_repeat(F.lit(0), width))).withColumn("whole", F.col("first").isNull())
    spread = spread.withColumn("bucket", F.pmod(F.xxhash64("key", "i", "j"), 1 + F.ceil(row_count(postings) / BUCKET)))

    def counted(frame: pd.DataFrame) -> pd.DataFrame:
        """All lists of a bucket: pandas frames are dear, so one holds many short lists."""
        frame = frame.sort_values(["key", "i", "j", "whole", "comp"], ignore_index=True)
        key, i, j, comp, size, own, pos = (frame[c].to_numpy(np.int64) for c in ("key", "i", "j", "comp", "n_shingles", "_own", "pos"))
        whole = frame["whole"].to_numpy(bool)
        sig = np.array(frame["sig"].tolist(), np.int32).reshape(len(frame), -1)
        prefix = np.zeros((len(frame), COORDINATES), bool)
        for row, first in zip(prefix, frame["first"]):
            if first is not None:
                row[first] = True
        new = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        edges = np.concatenate([[0], np.flatnonzero(new) + 1, [len(frame)]])
        found, forest = set(), _Forest()
        for low, high in zip(edges[:-1], edges[1:]):
            same_block = i[low] == j[low]
            few = low + int(np.searchsorted(whole[low:high], True))  # single classes first, then whole components
            for at in range(few, high):
                other = comp[low:high][(comp[low:high] != comp[at]) & (same_block | (own[low:high] != own[at]))]
                found.update((min(comp[at], c), max(comp[at], c)) for c in np.unique(other))
            beyond = low + np.searchsorted(comp[low:few], comp[low:few], "right")  # where the next component starts
            for at, start in zip(range(low, few), beyond):
                if start == few:
                    break
                equal = sig[start:few] == sig[at]
                near = np.count_nonzero(equal[:, :COORDINATES], axis=1) >= matches
                near &= np.count_nonzero(equal, axis=1) >= ALL_MATCHES
                near &= 100 * np.minimum(size[start:few], size[at]) >= PERCENT * np.maximum(size[start:few], size[at])
                if not same_block:
                    near &= own[start:few] != own[at]
                if near.any():
                    near = np.flatnonzero(near)
                    # Of the lists that two classes share, the one of the first coordinate reports them.
                    both = equal[near, :COORDINATES] & prefix[start + near] & prefix[at]
                    forest.join(int(comp[at]), np.unique(comp[start + near[both.argmax(axis=1) == pos[at]]]).tolist())
        found = sorted(found)
        rows = pd.DataFrame(found + forest.edges, columns=["a", "b"], dtype="int64")
        return rows.assign(whole=np.arange(len(rows)) < len(found))

    return spread.fillna(0, ["pos", "n_shingles"]).groupBy("bucket").applyInPandas(counted, "a long, b long, whole boolean").distinct()


def checked(pairs, members, sets, block=BLOCK):
    """(g, p): the pairs with a link between a class of g and one of p, on their full sets.

    members: (cls, comp). The members of g are dealt into blocks, the classes of all its
    partners as well, and every block of one meets every block of the other.
    """
    held = members.join(sets, "cls")
    sizes = members.groupBy("comp").agg(F.count("*").alias("size"))
    partner = pairs.join(sizes.withColumnRenamed("comp", "p"), "p").groupBy("g").agg(F.sum("size").alias("_partners"))
    grid = sizes.withColumnRenamed("comp", "g").join(partner, "g").select(
        "g", F.ceil(F.col("size") / block).cast("int").alias("_rows"), F.ceil(F.col("_partners") / block).cast("int").alias("_columns")
    )
    dealt = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    left = (
        held.withColumnRenamed("comp", "g").join(grid, "g").withColumn("_i", dealt("_rows"))
        .select("g", "_i", F.explode(F.sequence(F.lit(0), F.col("_columns") - 1)).alias("_j"), "shingles")
    )
    right = (
        pairs.join(held.withColumnRenamed("comp", "p"), "p").join(grid, "g").withColumn("_j", dealt("_columns"))
        .select("g", "p", "_j", F.explode(F.sequence(F.lit(0), F.col("_rows") - 1)).alias("_i"), "shingles")
    )

    def linked(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        """All blocks of a bucket, one after the other."""
        partners = {}
        for g, i, j, p, packed in zip(theirs["g"], theirs["_i"], theirs["_j"], theirs["p"], theirs["shingles"]):
            partners.setdefault((g, i, j), []).append((p, np.frombuffer(packed, np.uint64)))
        blocks = {}
        for g, i, j, packed in zip(ours["g"], ours["_i"], ours["_j"], ours["shingles"]):
            blocks.setdefault((g, i, j), []).append(np.frombuffer(packed, np.uint64))
        found = sorted({(block[0], p) for block, sets in blocks.items() for p in _near(sets, partners.get(block, ()))})
        return pd.DataFrame({"g": [g for g, _ in found], "p": [p for _, p in found]}, dtype="int64")

    bucket = F.pmod(F.xxhash64("g", "_i", "_j"), 1 + F.ceil(row_count(pairs) / BUCKET))
    left, right = left.withColumn("bucket", bucket), right.withColumn("bucket", bucket)
    # Both sides come from one table; fresh column identities keep them apart.
    met = left.toDF(*left.columns).groupBy("bucket").cogroup(right.toDF(*right.columns).groupBy("bucket"))
    return met.applyInPandas(linked, "g long, p long").distinct()


def checked_in_blocks(pairs, members, sets, block=4 * BLOCK):
    """(g, p): the pairs of components with a link between a class of one and one of the other, on their full sets.

    Components are dealt into blocks of about `block` classes, large ones into several.
    Two blocks meet in one task if any pair lies in them, and only components of such
    pairs go there: a class travels once for a block of partners, however many partners
    it has in it. Pairs of classes are made inside the task, never as rows.
    """
    parts = F.ceil(F.col("size") / block).cast("int")
    sizes = members.groupBy("comp").agg(F.count("*").alias("size"))
    paired = pairs.select(F.col("g").alias("comp")).unionByName(pairs.select(F.col("p").alias("comp"))).distinct()
    sized = sizes.join(paired, "comp")
    blocks = 1 + F.ceil(F.coalesce(sized.agg(F.sum("size")).scalar(), F.lit(0)) / block)
    home = lambda part: F.pmod(F.xxhash64("comp", part), blocks).cast("int")
    parts_of = sized.select("comp", parts.alias("_parts"))
    lying = parts_of.select("comp", F.explode(F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda x: x)).alias("_part"))
    lying = lying.select("comp", home("_part").alias("blk")).distinct()
    met = (
        pairs.join(lying.select(F.col("comp").alias("g"), F.col("blk").alias("i")), "g")
        .join(lying.select(F.col("comp").alias("p"), F.col("blk").alias("j")), "p")
    )
    held = members.join(parts_of, "comp").withColumn("blk", home(F.pmod(F.xxhash64("cls"), F.col("_parts")).cast("int"))).select("cls", "comp", "blk").join(sets, "cls")

    def side(name, at):
        wanted = met.select(F.col(name).alias("comp"), "i", "j").distinct()
        return wanted.withColumn("blk", F.col(at)).join(held, ["comp", "blk"]).select("i", "j", "comp", "shingles")

    left = side("g", "i")
    right = side("p", "j").withColumn("g", F.lit(None).cast("long")).unionByName(
        met.select("i", "j", F.col("p").alias("comp"), F.lit(None).cast("binary").alias("shingles"), "g")
    )

    def linked(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        def sets_of(frame):
            out = {}
            for comp, packed in zip(frame["comp"], frame["shingles"]):
                out.setdefault(comp, []).append(np.frombuffer(packed, np.uint64))
            return out

        listed = theirs["shingles"].isna()
        mine, others = sets_of(ours), sets_of(theirs[~listed])
        asked = {}
        for g, p in zip(theirs.loc[listed, "g"], theirs.loc[listed, "comp"]):
            asked.setdefault(int(g), []).append(p)
        found = []
        for g, ps in asked.items():
            partners = [(p, own) for p in ps for own in others.get(p, ())]
            found += [(g, p) for p in _near(mine[g], partners)] if g in mine else []
        return pd.DataFrame({"g": [g for g, _ in found], "p": [p for _, p in found]}, dtype="int64")

    # Both sides come from one table; fresh column identities keep them apart.
    both = left.toDF(*left.columns).groupBy("i", "j").cogroup(right.toDF(*right.columns).groupBy("i", "j"))
    return both.applyInPandas(linked, "g long, p long").distinct()


def checked_in_clusters(edges, members, sets, keep, block=4 * BLOCK):
    """(g, p): spanning edges of the links between the components of a cluster, on their full sets.

    edges: (a, b), whose connected components are the clusters. Components are dealt into
    blocks of about `block` classes, one with more classes into blocks of its own; every
    two blocks of a cluster meet in one task, but for two of the same component.
    """
    cluster = keep(connected_components(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("node").alias("comp"), F.col("component").alias("cluster")), "clusters")
    sizes = members.join(cluster, "comp").groupBy("cluster", "comp").agg(F.count("*").alias("size"))
    large = F.col("size") > block
    small = sizes.groupBy("cluster").agg(F.ceil(F.sum(F.when(large, 0).otherwise(F.col("size"))) / block).cast("int").alias("_blocks"))
    homes = sizes.join(small, "cluster").select(
        "cluster", "comp", F.when(large, F.col("comp")).otherwise(-1).alias("own"), F.when(large, F.ceil(F.col("size") / block).cast("int")).alias("_parts"), "_blocks",
    )
    at = F.coalesce(F.pmod(F.xxhash64("cls"), F.col("_parts")), F.pmod(F.xxhash64("comp"), F.col("_blocks"))).cast("int")
    held = members.join(homes, "comp").select("cluster", "cls", "comp", F.struct("own", at.alias("at")).alias("blk"))
    held = keep(held, "cluster-members")
    blocks = held.select("cluster", "blk").distinct()
    met = blocks.withColumnRenamed("blk", "i").join(blocks.select(F.col("cluster").alias("_c"), F.col("blk").alias("j")), (F.col("cluster") == F.col("_c")) & (F.col("i") <= F.col("j"))).drop("_c")
    met = met.where((F.col("i.own") == -1) | (F.col("i.own") != F.col("j.own")))
    met = met.withColumn("bucket", F.pmod(F.xxhash64("cluster", "i", "j"), 1 + F.ceil(row_count(held) / BUCKET)))
    sides = F.when(F.col("i") == F.col("j"), F.array(F.struct(F.col("i").alias("blk"), F.lit(3).alias("side")))).otherwise(
        F.array(F.struct(F.col("i").alias("blk"), F.lit(1).alias("side")), F.struct(F.col("j").alias("blk"), F.lit(2).alias("side")))
    )
    places = met.select("cluster", "bucket", F.xxhash64("i", "j").alias("task"), F.inline(sides))
    rows = places.join(held.join(sets, "cls"), ["cluster", "blk"]).select("bucket", "cluster", "task", "side", "comp", "shingles")

    def linked(frame: pd.DataFrame) -> pd.DataFrame:
        """All pairs of blocks in a bucket, one after the other."""
        forest = _Forest()
        for _, met in frame.groupby(["cluster", "task"]):
            left, right = met[met["side"] != 2], met[met["side"] != 1]
            _link(forest, left["comp"].to_numpy(), _sets(left), right["comp"].to_numpy(), _sets(right))
        return pd.DataFrame(forest.edges, columns=["g", "p"], dtype="int64")

    return rows.groupBy("bucket").applyInPandas(linked, "g long, p long").distinct()


def _sets(frame):
    return [np.frombuffer(packed, np.uint64) for packed in frame["shingles"]]


def _index(sets):
    """(sizes, shingles in order, the set of each)."""
    size = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    return size, flat[order], owner[order]


def _similar(index, own):
    """Which sets of an index have a similarity of `PERCENT` or more to the set `own`."""
    size, flat, owner = index
    low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
    n = high - low
    hit = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    common = np.bincount(owner[hit], minlength=len(size))
    return 100 * common >= PERCENT * (size + len(own) - common)


def _link(forest, comps, sets, other_comps, others):
    """Join the components of similar sets, in a forest."""
    if not sets or not others:
        return
    index = _index(sets)
    for comp, own in zip(other_comps.tolist(), others):
        forest.join(comp, np.unique(comps[_similar(index, own)]).tolist())


def _near(sets, partners):
    """The partners (p, set) with a similarity of `PERCENT` or more to one of the sets."""
    if not partners:
        return set()
    index, found = _index(sets), set()
    for p, own in partners:
        if p not in found and _similar(index, own).any():
            found.add(p)
    return found


# --- groups -----------------------------------------------------------------------


def near_duplicates(docs, id_col="doc_id", text="text"):
    """Per row: id, n_shingles, component_id (the smallest id of its group) and kept (it has that id).

    Two tables stay in the shared folder for the result to read, signatures and
    groups; all others are deleted.
    """
    rows = stored(signed(docs, id_col, text), "signed")
    with stage_folder(docs.sparkSession, "near-duplicates") as keep:
        every = stored(_groups(docs, rows, keep, id_col, text), "groups")
    component = F.when(F.col("id").isNotNull(), F.coalesce("_component", "id"))
    return rows.join(every, "digest", "left").select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )


def _groups(docs, rows, keep, id_col, text):
    """(digest, _component): the smallest id of the group of every class."""
    grouped = rows.where("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("label"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("more").alias("more")
    )
    classes = keep(grouped.select(F.monotonically_increasing_id().alias("cls"), "*"), "classes")
    postings = keep(prefix_postings(classes, keep), "prefixes")
    wanted = classes.join(postings.select("cls").distinct(), "cls", "left_semi")
    sets = keep(full_sets(docs, wanted, id_col, text), "shingle-sets")
    alone = wanted.select("cls", F.col("cls").alias("comp"))
    first = keep(checked(keep(hub_pairs(postings), "hubs"), alone, sets).select(F.col("g").alias("u"), F.col("p").alias("v")), "hub-links")
    one = keep(connected_components(first).select(F.col("node").alias("cls"), F.col("component").alias("comp")), "components")
    members = alone.select("cls").join(one, "cls", "left").select("cls", F.coalesce("comp", "cls").alias("comp"))
    size = members.groupBy("comp").agg(F.count("*").alias("n"))
    found = keep(open_pairs(postings, classes, one), "open-pairs")
    sized = found.where("whole").join(size.withColumnRenamed("comp", "a").withColumnRenamed("n", "_na"), "a").join(
        size.withColumnRenamed("comp", "b").withColumnRenamed("n", "_nb"), "b"
    )
    larger = F.col("_na") >= F.col("_nb")  # the larger component is the side that stays, its partners come to it
    pairs = sized.select(F.when(larger, F.col("a")).otherwise(F.col("b")).alias("g"), F.when(larger, F.col("b")).otherwise(F.col("a")).alias("p"))
    links = checked_in_blocks(keep(pairs, "pairs"), members, sets).unionByName(checked_in_clusters(found.where("NOT whole"), members, sets, keep))
    between = keep(links.select(F.col("g").alias("u"), F.col("p").alias("v")), "open-links")
    two = keep(connected_components(between).select(F.col("node").alias("comp"), F.col("component").alias("joined")), "joined-components")
    final = members.join(two, "comp", "left").select("cls", F.coalesce("joined", "comp").alias("comp"))
    labelled = final.join(classes.select("cls", "label", "digest"), "cls")
    smallest = labelled.groupBy("comp").agg(F.min("label").alias("smallest"))
    named = labelled.join(smallest, "comp").select("digest", "smallest")
    return classes.select("digest", "label").join(named, "digest", "left").select("digest", F.coalesce("smallest", "label").alias("_component"))


def drop_near_duplicates(docs, id_col="doc_id", text="text"):
    """The rows of `docs` without those of which a near duplicate with a smaller id stays."""
    gone = near_duplicates(docs, id_col, text).where(~F.col("kept")).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, F.col(f"`{id_col}`") == F.col("_gone"), "left_anti")
